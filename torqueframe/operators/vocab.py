"""Vocabularies, replacement maps and category groupings that
must equal the original tables for identical results. Kept in their natural
order (list order decides which colour wins)."""

# exterior/interior colour words, Portuguese list, in order.
COLOURS_PT = [
    "preto", "branco", "azul", "verde", "tartufo", "vermelho", "antracite/vermelho", "dacota",
    "anthtacite/preto", "preto/laranja/preto/lara", "prata/cinza", "cinza", "preto/silver",
    "cinzento", "prateado", "prata", "amarelo", "laranja", "castanho", "dourado", "antracit",
    "antracite/preto", "antracite/cinza/preto", "branco/outras", "antracito", "dakota",
    "antracite", "antracite/vermelho/preto", "oyster/preto", "prata/preto/preto",
    "âmbar/preto/pr", "bege", "terra", "preto/laranja", "cognac/preto", "bronze", "beige",
    "beje", "veneto/preto", "zagora/preto", "mokka/preto", "taupe/preto", "sonoma/preto",
    "preto/preto", "preto/laranja/preto",
]

# Colour words, English list, in order.
COLOURS_EN = [
    "black", "havanna", "merino", "vernasca", "walnut", "chocolate", "nevada", "vernasca",
    "moonstone", "anthracite/silver", "white", "coffee", "blue", "red", "grey", "silver",
    "orange", "green", "bluestone", "aqua", "burgundy", "anthrazit", "truffle", "brown",
    "oyster", "tobacco", "jatoba", "storm", "champagne", "cedar", "silverstone", "chestnut",
    "kaschmirsilber", "oak", "mokka",
]

# Canonical colour names (applied to both colour columns).
COLOUR_CANONICAL = {
    "black": "preto", "preto/silver": "preto/prateado", "tartufo": "truffle",
    "preto/laranja/preto/lara": "preto/laranja", "dacota": "dakota", "white": "branco",
    "blue": "azul", "red": "vermelho", "grey": "cinzento", "silver": "prateado",
    "orange": "laranja", "green": "verde", "anthrazit": "antracite", "antracit": "antracite",
    "brown": "castanho", "antracito": "antracite", "âmbar/preto/pr": "ambar/preto/preto",
    "beige": "bege", "kaschmirsilber": "cashmere", "beje": "bege",
}

# Option words that set the three equipment flags. As coded,
# "'a' and 'b' in tokens" tests only the second word.
FLAG_WORDS = {"navegacao": "navegação", "sensores": "dianteiros", "caixa_auto": "automática"}

# Interior overrides. A token 'truffle' forces 'truffle'; a
# token 'standard' forces 'preto'. Several matches: rules (word, result) in
# order, a rule applies when all its words are tokens and the last rule
# that applies wins (intended reading); as coded the
# final rule always applies, so every multi-match becomes 'vernasca'.
INTERIOR_FORCE = [("truffle", "truffle"), ("standard", "preto")]
INTERIOR_MULTI_RULES = [
    (["dakota"], "dakota"),
    (["nevada"], "nevada"),
    (["preto", "antracite"], "preto/antracite"),
    (["beje", "havanna"], "beje"),
    (["bege", "veneto"], "bege"),
    (["bege", "preto"], "bege"),
    (["bege", "sonoma/preto"], "bege"),
    (["dacota", "bege"], "dakota"),
    (["bege", "zagora/preto"], "bege"),
    (["bege", "veneto"], "bege"),
    (["vernasca", "anthtacite/preto"], "vernasca"),
]
INTERIOR_MULTI_AS_CODED = "vernasca"

# Wheel sizes looked for in the option tokens.
WHEEL_SIZES = ["15", "16", "17", "18", "19", "20"]

# Category groups, (group name, members) in order; a value in
# two groups takes the later group.
EXTERIOR_GROUPS = [
    ("preto", ["preto"]),
    ("cinzento", ["cinzento", "prateado", "prata", "cinza"]),
    ("branco", ["branco"]),
    ("azul", ["azul", "bluestone"]),
    ("verde", ["verde"]),
    ("vermelho/laranja", ["vermelho", "laranja"]),
    ("burgundy", ["burgundy"]),
    ("castanho", ["castanho"]),
    ("outros", ["jatoba", "aqua", "storm", "cedar", "bronze", "chestnut", "havanna", "cashmere",
                "champagne", "dourado", "amarelo", "bege", "silverstone", "moonstone"]),
]
INTERIOR_GROUPS = [
    ("preto", ["preto", "prata/preto/preto", "veneto/preto", "preto/preto", "ambar/preto/preto"]),
    ("antracite", ["antracite", "antracite/cinza/preto", "antracite/preto", "antracite/vermelho/preto",
                   "antracite/vermelho", "anthtacite/preto", "anthracite/silver"]),
    ("castanho", ["dakota", "castanho", "oak", "terra", "mokka", "vernasca"]),
    ("outros", ["champagne", "branco", "oyster", "prata/cinza", "bege", "oyster/preto", "azul",
                "cinzento", "truffle", "burgundy", "zagora/preto", "sonoma/preto", "laranja",
                "taupe/preto", "vermelho", "silverstone", "nevada", "cognac/preto", "preto/laranja",
                "preto/prateado"]),
]
WHEEL_GROUPS = [
    ("Standard", ["standard", "15", "16"]),
    ("17", ["17"]),
    ("18", ["18"]),
    ("19/20", ["19", "20"]),
]
SALES_PLACE_GROUPS = [
    ("norte", ["DCC - Feira", "DCG - Gaia", "DCN-Porto", "DCN-Porto Mini", "DCG - Gaia Mini",
               "DCN-Porto Usados", "DCG - Gaia Usados", "DCC - Feira Usados", "DCC - Aveiro Usados",
               "DCC - Viseu Usados"]),
    ("centro", ["DCV - Coimbrões", "DCC - Aveiro"]),
    ("sul", ["DCS-Expo Frotas Busi", "DCS-V Especiais BMW", "DCS-V Especiais MINI",
             "DCS-Expo Frotas Flee", "DCS-Cascais", "DCS-Parque Nações", "DCS-Parque Nações Mi",
             "DCS-24 Jul BMW Usad", "DCS-Cascais Usados", "DCS-24 Jul MINI Usad", "DCS-Lisboa Usados"]),
    ("motos", ["DCA - Motos Faro", "DCS- Vendas Motas", "DCC - Motos Aveiro"]),
    ("algarve", ["DCA - Faro", "DCA - Portimão", "DCA - Mini Faro", "DCA -Portimão Usados"]),
]
MODEL_GROUPS = [
    ("S1", ["S1 3p", "S1 5p"]),
    ("S2_gran", ["S2 Gran Tourer"]),
    ("S2_active", ["S2 Active Tourer"]),
    ("S3_touring", ["S3 Touring"]),
    ("S3_berlina", ["S3 Berlina"]),
    ("S4_Gran", ["S4 Gran Coupé"]),
    ("S5_Touring", ["S5 Touring"]),
    ("S5_Lim_Ber", ["S5 Limousine", "S5 Berlina"]),
    ("X1", ["X1"]),
    ("X3", ["X3 SUV"]),
    ("Motociclos", ["Série C", "Série F", "Série K", "Série R"]),
    ("Mini", ["MINI 5p", "MINI 3p"]),
    ("Mini_Club", ["MINI CLUBMAN"]),
    ("Mini_Cabrio", ["MINI CABRIO"]),
    ("Mini_Country", ["MINI COUNTRYMAN"]),
    ("Outros", ["S2 Cabrio", "S2 Gran Tourer", "S2 Coupé", "S3 Gran Turismo", "S4 Coupé", "S4 Cabrio",
                "S5 Gran Turismo", "S6 Cabrio", "S6 Gran Turismo", "S6 Gran Coupe", "S6 Coupé",
                "S7 Berlina", "S7 L Berlina", "X2 SAC", "X4 SUV", "X5 SUV", "X5 M", "X6", "X6 M",
                "Z4 Roadster", "M2 Coupé", "M3 Berlina", "M4 Cabrio", "M4 Coupé"]),
]
# Provenance renamed before grouping.
PROVENANCE_RENAME = {"Viaturas Km 0": "Novos"}
