"""Option-line extraction to one feature row per vehicle (H6–H13, D1, E9,
E10).

All per-vehicle results come from **one** ``groupBy(vehicle)``: flags are
``max`` over lines, "first line" values are ``min_by(value, line order)``,
"last line with a size" is ``max_by``. These aggregates are partially
computed before the shuffle, so a vehicle with very many lines does not land
on a single task unreduced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import shorten_model, tokenize
from . import vocab


def _arr(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def first_vocab_match(tokens, primary: Sequence[str], secondary: Sequence[str] = ()) -> Column:
    """First word of ``primary`` (in list order) found in the tokens, else the
    first of ``secondary``, else null (H8)."""
    tok = tokens if isinstance(tokens, Column) else F.col(tokens)
    p = F.try_element_at(F.array_intersect(_arr(primary), tok), F.lit(1))
    if secondary:
        return F.coalesce(p, F.try_element_at(F.array_intersect(_arr(secondary), tok), F.lit(1)))
    return p


def interior_colour(tokens, primary=vocab.COLOURS_PT, secondary=vocab.COLOURS_EN,
                    ruleset: str = "as_coded") -> Column:
    """Interior colour (H9): matches of the first list that has any; forced
    values for 'truffle' / 'standard'; several matches resolved by the rule
    list (``ruleset='intended'``: last applicable rule, null if none) or, as
    coded, always 'vernasca'. No match → null."""
    tok = tokens if isinstance(tokens, Column) else F.col(tokens)
    m_p = F.array_intersect(_arr(primary), tok)
    m_s = F.array_intersect(_arr(secondary), tok)
    return resolve_interior(tok, F.when(F.size(m_p) > 0, m_p).otherwise(m_s), ruleset)


def resolve_interior(tok: Column, matches: Column, ruleset: str = "as_coded") -> Column:
    forced = None
    for word, result in vocab.INTERIOR_FORCE:   # later forced value wins
        forced = (F.when(F.array_contains(tok, word), F.lit(result)) if forced is None
                  else F.when(F.array_contains(tok, word), F.lit(result)).otherwise(forced))
    if ruleset == "as_coded":
        multi = F.lit(vocab.INTERIOR_MULTI_AS_CODED)
    else:
        multi = F.lit(None).cast("string")
        for words, result in vocab.INTERIOR_MULTI_RULES:
            applies = F.lit(True)
            for w in words:
                applies = applies & F.array_contains(tok, w)
            multi = F.when(applies, F.lit(result)).otherwise(multi)
    return (F.when(forced.isNotNull(), forced)
            .when(F.size(matches) == 0, F.lit(None).cast("string"))
            .when(F.size(matches) > 1, multi)
            .otherwise(F.element_at(matches, 1)))


def line_wheel_size(tokens, sizes: Sequence[str] = vocab.WHEEL_SIZES) -> Column:
    """Largest listed size among a line's tokens, null if none."""
    tok = tokens if isinstance(tokens, Column) else F.col(tokens)
    return F.array_max(F.array_intersect(_arr(sizes), tok).cast("array<int>"))


def vehicle_features(lines: DataFrame, vehicle: str, line_order: Sequence[str],
                     option: str, exterior: str, interior: str, model: str, cost: str,
                     flag_words: Mapping[str, str] = vocab.FLAG_WORDS,
                     exterior_vocab: tuple = (vocab.COLOURS_PT, vocab.COLOURS_EN),
                     interior_vocab: tuple = (vocab.COLOURS_PT, vocab.COLOURS_EN),
                     wheel_sizes: Sequence[str] = vocab.WHEEL_SIZES,
                     ruleset: str = "as_coded", model_lead: str = "Série",
                     first_line_cols: Sequence[str] = (), extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per vehicle (H7–H11, D1): equipment flags (0/1), exterior and
    interior colour of the first line (null = unknown), wheel size of the
    last line that names one (``standard`` if none), shortened model of the
    first line, summed cost, plus ``first_line_cols`` taken from the first
    line (E10) and any ``extra_aggs``. Text is lower-cased before
    tokenising, except the model.

    Each line is tokenised once in a projection; the per-line flags and
    wheel size are derived from that column, then one ``groupBy`` reduces
    the lines (partially, before the shuffle)."""
    order = F.struct(*[F.col(c) for c in line_order]).alias("_ord")
    per_line = lines.select(vehicle, order, tokenize(F.lower(F.col(option))).alias("_tok"),
                            F.col(exterior), F.col(interior), F.col(model), F.col(cost),
                            *[F.col(c) for c in first_line_cols],
                            *[F.col(c) for c in set(lines.columns) - {vehicle, exterior, interior, model, cost,
                                                                       *first_line_cols}])
    per_line = per_line.select(
        "*", *[F.array_contains("_tok", w).cast("int").alias(f"_f_{name}") for name, w in flag_words.items()],
        line_wheel_size("_tok", wheel_sizes).alias("_size"))
    aggs = [F.max(f"_f_{name}").cast("bigint").alias(name) for name in flag_words]
    aggs += [
        F.min_by(F.struct(F.lower(F.col(exterior)).alias("e"), F.lower(F.col(interior)).alias("i"),
                          F.col(model).alias("m"), *[F.col(c) for c in first_line_cols]), "_ord").alias("_first"),
        F.max_by("_size", F.when(F.col("_size").isNotNull(), F.col("_ord"))).alias("_wheel"),
        F.sum(cost).alias("price_total"),
        F.count(F.lit(1)).alias("n_lines"),
        *extra_aggs,
    ]
    g = per_line.groupBy(vehicle).agg(*aggs)
    extra_names = [c for c in g.columns if c not in {vehicle, *flag_words, "_first", "_wheel", "price_total",
                                                       "n_lines"}]
    g = g.select(vehicle, *flag_words, "_wheel", "price_total", "n_lines", *extra_names,
                 *[F.col(f"_first.{c}").alias(c) for c in first_line_cols],
                 tokenize(F.col("_first.e")).alias("_ext_tok"), tokenize(F.col("_first.i")).alias("_int_tok"),
                 tokenize(F.col("_first.m")).alias("_model_tok"))
    ip, isec = interior_vocab
    g = g.select("*", F.array_intersect(_arr(ip), "_int_tok").alias("_mp"),
                 F.array_intersect(_arr(isec), "_int_tok").alias("_ms"))
    g = g.select("*", F.when(F.size("_mp") > 0, F.col("_mp")).otherwise(F.col("_ms")).alias("_im"))
    return g.select(
        vehicle, *flag_words.keys(),
        first_vocab_match(F.col("_ext_tok"), *exterior_vocab).alias("cor_exterior"),
        resolve_interior(F.col("_int_tok"), F.col("_im"), ruleset).alias("cor_interior"),
        F.coalesce(F.col("_wheel").cast("string"), F.lit("standard")).alias("jantes"),
        shorten_model(F.col("_model_tok"), model_lead).alias("modelo"),
        "price_total", F.col("n_lines").cast("bigint").alias("n_lines"), *first_line_cols, *extra_names)


def group_table(spark: SparkSession, groups, attr: str = "attr") -> DataFrame:
    """Mapping rows ``(raw, grp, rank)``; the highest rank wins when a value
    is listed twice (a later list overrides an earlier one)."""
    rows = []
    rank = 0
    for name, members in groups:
        for m in members:
            rank += 1
            rows.append((m, name, rank))
    return spark.createDataFrame(rows, "raw string, grp string, rank int")


def group_map(df: DataFrame, col: str, table: DataFrame, out: str | None = None) -> DataFrame:
    """Category grouping by lists (H13): value → group, unlisted → null. The
    mapping table is a literal list (bounded), de-duplicated and broadcast."""
    dedup = table.groupBy("raw").agg(F.max_by("grp", "rank").alias("_grp"))
    t = F.broadcast(dedup.withColumnRenamed("raw", "_raw"))
    out = out or f"{col}_new"
    return df.join(t, df[col] == t["_raw"], "left").withColumnRenamed("_grp", out).drop("_raw")


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row of each key in ``order`` (E9: keep-first de-duplication).
    ``min_by`` over a struct of the row: an aggregate, so it is reduced
    map-side before the shuffle."""
    others = [c for c in df.columns if c != key]
    order_s = F.struct(*[F.col(c) for c in order])
    g = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order_s).alias("_r"))
    return g.select(key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def category_groups(spark: SparkSession, df: DataFrame, columns: Mapping[str, Sequence] | None = None,
                    provenance: str | None = None, drop_raw: bool = True) -> DataFrame:
    """Run every list grouping (H14): ``{col}_new`` from each group list,
    provenance renamed (``Viaturas Km 0`` → ``Novos``) into ``{prov}_new``,
    raw columns dropped. ``columns`` maps column → group list; the default
    uses the vehicle-table names and the dealer group lists."""
    columns = dict(columns or {"cor_exterior": vocab.EXTERIOR_GROUPS, "cor_interior": vocab.INTERIOR_GROUPS,
                               "jantes": vocab.WHEEL_GROUPS, "modelo": vocab.MODEL_GROUPS,
                               "local_da_venda": vocab.SALES_PLACE_GROUPS})
    out = df
    for col, groups in columns.items():
        if col in out.columns:
            out = group_map(out, col, group_table(spark, groups))
    if provenance and provenance in out.columns:
        p = F.col(provenance)
        for raw, new in vocab.PROVENANCE_RENAME.items():
            p = F.when(F.col(provenance) == raw, F.lit(new)).otherwise(p)
        out = out.withColumn(f"{provenance}_new", p)
    if drop_raw:
        out = out.drop(*[c for c in [*columns, provenance] if c and c in df.columns])
    return out
