"""Domain stand-ins built from the shared test tables.

The original works on dealer extracts that are not shipped; these functions
derive tables of the same shape from the TPC-H-like tables so every operator
runs on data that grows with the scale factor:

* ``sales``        one row per line: configuration (part type,
                   colour word, item word), sell date, stock days, margin %
* ``option_lines`` one row per option line of a vehicle (= order)
* ``orders_meta``  buy date and margin per vehicle
* ``visits``       one row per workshop visit (= order) of a vehicle
                   (= customer), with injected nulls
* ``contracts``    maintenance contracts; null for part of the vehicles
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classes import binary_target
from ..functions.dates import whole_days
from ..operators import vocab
from ..sources.tables import table

SALE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
CONFIG = ["cfg_type", "cfg_colour", "cfg_item"]
SALE_ORDER = ["sell_date", *SALE_KEY]
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
AS_OF = "2001-08-01"
NEW_SCORE_DAYS = 365


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def sales(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                            "l_extendedprice", "l_discount", "l_shipdate")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    # the earlier date is the purchase, the later one the sale: no line is dropped
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(o, li.l_orderkey == o.o_orderkey)
           .withColumns({"buy_date": F.least("o_orderdate", "l_shipdate"),
                         "sell_date": F.greatest("o_orderdate", "l_shipdate")}))
    days = whole_days("buy_date", "sell_date")
    margin = F.col("l_discount") * 100
    return j.select(
        *SALE_KEY, "sell_date", "buy_date",
        F.col("p_type").alias("cfg_type"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("cfg_colour"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("cfg_item"),
        days.alias("stock_days"), margin.alias("margem_percentagem"),
        binary_target(days, margin, NEW_SCORE_DAYS, 3.5).alias("new_score"))


def option_lines(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                            "l_extendedprice", "l_shipdate")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        "l_orderkey", *LINE_ORDER,
        F.concat_ws(" ", "p_type", "p_name", F.col("p_size").cast("string")).alias("opcional"),
        F.col("p_name").alias("cor"),
        F.concat_ws(" ", "p_name", "p_type").alias("interior"),
        F.concat_ws(" ", "p_brand", "p_type", "p_name", F.col("p_size").cast("string")).alias("modelo"),
        F.col("l_extendedprice").alias("custo"))


def raw_option_lines(spark: SparkSession, d: str) -> DataFrame:
    """Option lines as an extract has them: price-only lines, symbols in the
    colour texts, a model suffix, a missing colour, and code columns that the
    flow drops."""
    o = option_lines(spark, d)
    p = table(spark, d, "part").select("p_partkey", "p_type", "p_size")
    j = o.join(p, o["l_partkey"] == p["p_partkey"]).drop("p_partkey")
    return j.select(
        "l_orderkey", *LINE_ORDER,
        F.when(F.col("l_linenumber") == 7, F.lit("Preço de Venda")).otherwise(F.col("opcional")).alias("opcional"),
        F.when((F.col("l_linenumber") == 6) & (F.col("l_partkey") % 10 == 0), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("|"), "cor")).alias("cor"),
        F.concat("cor", F.lit(".ind. "), "p_type").alias("interior"),
        F.concat("modelo", F.when(F.col("p_size") % 2 == 0, F.lit(" - não utilizar")).otherwise(F.lit("")))
         .alias("modelo"),
        "custo", F.lit(None).cast("string").alias("cdint"), F.lit(None).cast("string").alias("cdcor"))


# Stand-in vocabularies for the option text (the dealer vocabularies are the
# defaults of the operators; the test tables use other words).
EXTERIOR_VOCAB = (["red", "blue"], ["hot", "cold", "new"])
INTERIOR_VOCAB = (["red", "blue", "hot", "gear", "bolt"], ["cold", "new", "ring"])
FLAG_WORDS = {"navegacao": "widget", "sensores": "gear", "caixa_auto": "economy"}
MODEL_LEAD = "Brand#1"


def orders_meta(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("buy_date"),
                    (F.col("o_totalprice") * 0.05).alias("margem"))


# Stand-in groups of the option words; wheels and sales places have the dealer's.
MODEL_WORDS = ["STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO"]
GROUPS = {
    "cor_exterior": [("vermelho", ["vermelho"]), ("azul", ["azul"]), ("outros", ["hot", "cold", "new"])],
    "cor_interior": [("preto", ["preto"]), ("quente", ["vermelho", "hot"]), ("azul", ["azul", "cold"]),
                     ("outros", ["vernasca", "new", "gear", "bolt", "ring"])],
    "jantes": vocab.WHEEL_GROUPS,
    "modelo": [(f"S{n}", [f"Brand#{b} {w}" for b in range(n, 26, 5) for w in MODEL_WORDS]) for n in range(1, 6)],
    "local_da_venda": vocab.SALES_PLACE_GROUPS,
}
PLACES = ["DCC - Feira", "DCC - Aveiro", "DCS-Cascais", "DCA - Faro", "DCN-Porto", "DCS-Lisboa Usados"]
EXCLUDED_MODELS = ["PROMO"]


def with_places(vehicles: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Vehicles with the provenance and the sales place of their order."""
    o = table(spark, d, "orders")
    place = F.element_at(F.array(*[F.lit(p) for p in PLACES]), (F.col("o_custkey") % len(PLACES) + 1).cast("int"))
    low = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    prov = (F.when(low, "Em utilização").when(F.col("o_orderpriority") == "1-URGENT", "Novos")
            .when(F.col("o_orderpriority") == "2-HIGH", "Viaturas Km 0")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Demonstração").otherwise("Usados"))
    meta = o.select(F.col("o_orderkey").alias("l_orderkey"), prov.alias("prov"), place.alias("local_da_venda"))
    return vehicles.join(meta, "l_orderkey", "left")


def visits(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    plate = F.lpad(F.col("o_custkey").cast("string"), 6, "0")
    missing_plate = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    no_arrival = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return j.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer"),
        F.when(missing_plate, F.lit(None)).otherwise(plate).alias("registration_number"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
         .otherwise(F.concat(F.lit("WBA"), F.lpad(F.col("o_custkey").cast("string"), 7, "0"))).alias("chassis_number"),
        F.when(no_arrival, F.lit(None)).otherwise(F.col("o_orderdate")).alias("vehicle_in_date"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
         .otherwise(F.timestamp_add("DAY", F.col("c_nationkey") * 40, _ts("1994-06-01"))).alias("registration_date_pse"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
         .otherwise(F.timestamp_add("DAY", F.col("c_nationkey") * 25, _ts("1995-01-01"))).alias("registration_date_vhe"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(101))
         .when(F.col("c_mktsegment") == "MACHINERY", F.lit(701)).cast("bigint").alias("nlr_code"),
        F.floor(F.col("o_totalprice") / 10).cast("bigint").alias("kms"),
        (F.col("c_nationkey") / 4.0).alias("anos_viatura"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
         .otherwise(F.col("c_nationkey")).cast("bigint").alias("slr_document_account"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority"),
        (F.col("o_totalprice") - 100000.0).alias("total"))


def raw_visits(spark: SparkSession, d: str) -> DataFrame:
    """Visits as an extract has them: dashed plates and customers missing on
    some visits of a vehicle."""
    v = visits(spark, d)
    plate = F.col("registration_number")
    dashed = F.concat(F.substring(plate, 1, 2), F.lit("-"), F.substring(plate, 3, 2), F.lit("-"),
                      F.substring(plate, 5, 10))
    return v.withColumns({"registration_number": dashed,
                          "customer": F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("customer"))})


def contracts(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's row; one of the HOUSEHOLD segment has no contract, so its
    keys and contract columns are null."""
    c = table(spark, d, "customer")
    rows = c.select(
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("registration_number"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
         .otherwise(F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("chassis_number"),
        (F.col("c_nationkey") / 5.0 + 1).alias("cm_years"),
        (F.col("c_acctbal") * 5 + 20000).alias("cm_km"),
        _ts("1994-01-01").alias("cm_date_start"),
        F.timestamp_add("DAY", F.col("c_nationkey") * 73, _ts("1996-01-01")).alias("cm_date_end"),
        F.when(F.col("c_acctbal") < 0, F.timestamp_add("DAY", F.col("c_nationkey") * 20, _ts("1995-06-01")))
         .alias("cm_date_removal"), "c_mktsegment")
    held = F.col("c_mktsegment") != "HOUSEHOLD"
    return rows.select(*[F.when(held, F.col(n)).alias(n) for n in rows.columns if n != "c_mktsegment"])
