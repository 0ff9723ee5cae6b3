"""Demo views: the engine's input shapes derived from the driver's tables.

There are no health-care tables in the test data, so the views map
customers to entities, orders to admissions, the part brands of an order's
lines (ordered by line number, part key, brand) to the diagnosis codes, and the
number of urgent orders of a customer in a year to HMO months.  Years come from
the order date; the views take the ``years`` they are asked for and turn them
into a range of that date, which is pushed down to the Parquet scan.  A second
pair of views has its code arrays in the rows, as the original files do: the
words of a document, whose entity and date are those of the order with its key.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The demo codebook on the driver tables (key order c1, c2, c3).
DEMO_CODEBOOK = {
    "c1": {"ref_period": 1, "icd9": ["Brand#1"], "icd10": ["Brand#2"]},
    "c2": {"ref_period": 2, "claims_criteria": "primary", "icd9": ["Brand#2"],
           "icd10": ["Brand#7"], "icd10_exclusion": ["Brand#3"]},
    "c3": {"ref_period": 3, "claims_criteria": "first_two", "icd9": ["Brand#9"], "icd10": [],
           "icd9_exclusion": ["Brand#4"], "icd10_exclusion": ["Brand#5"]},
}

# One condition with rule "all", include Brand#1/Brand#2,
# exclusion Brand#3 and a two-year look-back (the exclusion example).
EXCL_CODEBOOK = {
    "x1": {"ref_period": 2, "icd9": ["Brand#1"], "icd10": ["Brand#2"],
           "icd9_exclusion": ["Brand#3"], "icd10_exclusion": ["Brand#3"]},
}

# Demo reference years and the first file year.
FIRST_YEAR = 1995
LAST_YEAR = 2001
REF_YEAR = 1999

# The demo codebook on words of documents (array-form events).
WORDS_CODEBOOK = {
    "w1": {"ref_period": 1, "icd9": ["The", "the"], "icd10": ["la"]},
    "w2": {"ref_period": 2, "claims_criteria": "primary", "icd9": ["The", "And"], "icd10": ["Le"],
           "icd9_exclusion": ["worthless", "scum"], "icd10_exclusion": ["idiot", "clown"]},
    "w3": {"ref_period": 3, "claims_criteria": "first_two", "icd9": ["of", "und"], "icd10": ["de"],
           "icd10_exclusion": ["loser", "stupid"]},
    "w4": {"ref_period": 1, "icd9": ["no such word"], "icd10": []},
}


def wide_codebook(n_conditions: int = 27, n_brands: int = 25) -> dict:
    """A larger demo codebook built by rule, for the full-size grid bench.

    Condition k looks back 1 year, except every ninth (3 years) and every fourth
    (2 years); rules cycle all / primary / first_two; every fifth condition has
    an exclusion list.  Codes are brands ``Brand#i``.
    """
    book = {}
    for k in range(n_conditions):
        period = 3 if k % 9 == 2 else (2 if k % 4 == 1 else 1)
        rule = ("all", "primary", "first_two")[k % 3]
        a, b = k % n_brands + 1, (k * 7 + 3) % n_brands + 1
        entry = {"ref_period": period, "claims_criteria": rule,
                 "icd9": [f"Brand#{a}"], "icd10": [f"Brand#{b}"]}
        if k % 5 == 0:
            e = (k * 3 + 11) % n_brands + 1
            entry["icd9_exclusion"] = [f"Brand#{e}"]
            entry["icd10_exclusion"] = [f"Brand#{e % n_brands + 1}"]
        book[f"k{k + 1:02d}"] = entry
    return book


#: Lines that one task ranks; its sorts hold some 300 bytes of each.
RANKED_LINES = 500_000
#: Parts are sent to all tasks up to this size, each counted as PART_BYTES (its row and hash entry).
PART_BROADCAST, PART_BYTES = 64 << 20, 48


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None,
            orders: DataFrame | None = None) -> DataFrame:
    """The orders of ``years`` (all by default); a run of years becomes a range of the order date."""
    orders = orders if orders is not None else _table(spark, sf_dir, "orders")
    if years is None:
        return orders
    day = orders.schema["o_orderdate"].dataType
    runs: list[list[int]] = []
    for y in sorted({int(y) for y in years}):
        if runs and runs[-1][1] == y - 1:
            runs[-1][1] = y
        else:
            runs.append([y, y])
    ranges = [(F.col("o_orderdate") >= F.lit(f"{a}-01-01").cast(day)) & (F.col("o_orderdate") < F.lit(f"{b + 1}-01-01").cast(day))
              for a, b in runs]
    return orders.where(functools.reduce(lambda a, b: a | b, ranges, F.lit(False)) if len(ranges) != 1 else ranges[0])


def demo_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """All file years of the demo tables from FIRST_YEAR on (one aggregate of two values)."""
    r = _table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    if r["a"] is None:
        return [FIRST_YEAR]
    if r["a"] < FIRST_YEAR:
        raise ValueError(f"orders of {r['a']} lie before the first file year {FIRST_YEAR}")
    return list(range(FIRST_YEAR, r["b"] + 1))


def demo_admissions(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """``adm_id, bene_id, admission_date, file_year``: the events without their codes."""
    return _orders(spark, sf_dir, years).select(
        F.col("o_orderkey").alias("adm_id"),
        F.col("o_custkey").alias("bene_id"),
        F.col("o_orderdate").alias("admission_date"),
        F.year("o_orderdate").cast("int").alias("file_year"),
    )


def demo_event_codes(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None,
                     years: Sequence[int] | None = None) -> DataFrame:
    """Long-form events: ``adm_id, bene_id, admission_date, file_year, pos, code``.

    One row per coded line of an order; ``pos`` is the 0-based rank of the line
    by (line number, part key, brand), the position the code has in the array
    form.  The rank is a ``row_number`` window per order: one shuffle by order
    key, and a spillable buffer, so no order's lines are ever held as one value.
    Lines are joined with the orders of ``years`` first, so no others are ranked.  ``orders`` replaces
    the orders table (same columns) when given.

    A task's sorts don't grow with the table: where the session's shuffle partitions would get more than
    ``RANKED_LINES`` lines each, lines are dealt over as many tasks as that takes (``_beside_orders``).
    """
    orders = _orders(spark, sf_dir, years, orders).select("o_orderkey", "o_custkey", "o_orderdate")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand").where(F.col("p_brand").isNotNull())
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "p_brand")
    return (_beside_orders(lines, orders, part).select(
        F.col("l_orderkey").alias("adm_id"),
        F.col("o_custkey").alias("bene_id"),
        F.col("o_orderdate").alias("admission_date"),
        F.year("o_orderdate").cast("int").alias("file_year"),
        (F.row_number().over(w) - 1).cast("int").alias("pos"),
        F.col("p_brand").alias("code"),
    ))


def _beside_orders(lines: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """``lines`` with their order and part, dealt by order over enough tasks for their number (counted by the footers)."""
    on_order, on_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    tasks = -(-lines.count() // RANKED_LINES)
    if tasks <= int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return lines.join(orders, on_order).join(part, on_part)
    if part.count() * PART_BYTES <= PART_BROADCAST:
        return lines.repartition(tasks, "l_orderkey").join(orders, on_order).join(F.broadcast(part), on_part)
    # Parts too many to be sent: their join deals the lines by part (hashed, as parts are fewer than lines; a hot part is
    # split by AQE), so it comes before the one by order, whose partitions the rank then needs.
    coded = lines.join(part.hint("shuffle_hash"), on_part)
    return coded.repartition(tasks, "l_orderkey").join(orders, on_order)


def demo_enrolment(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None,
                   years: Sequence[int] | None = None) -> DataFrame:
    """``bene_id, year, hmo_mo, file_year``: one row per customer and order year.

    ``orders`` replaces the orders table (same columns) when given.
    """
    orders = _orders(spark, sf_dir, years, orders)
    year = F.year("o_orderdate").cast("int")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    return (orders.groupBy(F.col("o_custkey").alias("bene_id"), year.alias("year"))
            .agg(F.sum(urgent).cast("int").alias("hmo_mo"))
            .withColumn("file_year", F.col("year")))


def _coded_documents(spark: SparkSession, sf_dir: str, years: Sequence[int] | None) -> DataFrame:
    """``documents`` beside the order whose key is their id (all documents, or those of orders of ``years``)."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    orders = _orders(spark, sf_dir, years).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return docs.join(orders, docs.doc_id == orders.o_orderkey, "left" if years is None else "inner")


def demo_documents(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """Array-form events out of ``documents``: ``adm_id, bene_id, admission_date, file_year, diagnoses``.

    A document is an admission, its words (split at spaces) are its codes; the entity, the date and the
    file year are those of the order with its key (NULL without such an order).
    """
    return _coded_documents(spark, sf_dir, years).select(
        F.col("doc_id").alias("adm_id"),
        F.col("o_custkey").alias("bene_id"),
        F.col("o_orderdate").alias("admission_date"),
        F.year("o_orderdate").cast("int").alias("file_year"),
        F.split("text", " ").alias("diagnoses"))


def demo_document_enrolment(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """``bene_id, year, hmo_mo, file_year`` beside :func:`demo_documents`: half a month for each urgent order."""
    year = F.year("o_orderdate").cast("int")
    return (_coded_documents(spark, sf_dir, years).where(F.col("o_orderdate").isNotNull()).groupBy(F.col("o_custkey").alias("bene_id"), year.alias("year"))
            .agg(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 0.5).otherwise(0.0)).alias("hmo_mo"))
            .withColumn("file_year", F.col("year")))
