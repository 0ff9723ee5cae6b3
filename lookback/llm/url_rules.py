"""URL filters: host and path rules, matched by a sorted sweep over reversed-host keys.

A rule is a host, a path prefix and a verdict.  It fits its host and every subdomain when the
url's path starts with the rule's path; of the rules that fit, the longest rule string wins, then
the longer host, then ``block`` before ``allow``.

Method.  A host is written with its labels reversed, each followed by a dot (``com.example.``), so
"host or subdomain" becomes "key starts with".  The key of a rule is its reversed host followed by
its path, and the keys of all urls that the rule fits form one interval.  A url takes part once for
each of its host suffixes that is a rule host (never more than the longest rule host has labels).
Rules and urls are sorted together within a rule host; the sweep is a running window that carries
the last rule started with the stack of rules that enclose it.  Nested prefixes make that stack
hold every rule still open at the url; those already closed are popped by comparing prefixes.

Scale.  Urls are reduced to distinct (host, path) first.  A rule host with many urls is dealt to
cells by a hash of the path and its rules are repeated per cell, at most as often as they are
outnumbered by urls, so a hot host neither meets in one task nor multiplies the data.  Only
DataFrame functions are used.

Defined cases: null url or no ``://``: host and path are empty and no rule fits; an empty table
gives no rows; repeated rows stay repeated; other columns of the input are kept if asked for by
name, except those called like a column that is made here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import ascii_lower, shuffle_partitions

RULES = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                      T.StructField("verdict", T.StringType())])


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """A rule table out of (verdict, "host/path") pairs."""
    rows = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        rows.append((host, slash + path, verdict))
    return spark.createDataFrame(rows, RULES)


def reversed_host(host):
    """``www.example.com`` -> ``com.example.www.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def split_url(url):
    """(host, path) columns of a url, by the rule in the module's docstring."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _stacks(rules: DataFrame) -> DataFrame:
    """Each distinct rule with the stack of rules of its host whose path is a prefix of its path."""
    lengths = rules.groupBy("_uhost").agg(F.collect_set(F.length("_upath")).alias("_ulens"))
    inner = (rules.join(lengths, "_uhost")
             .select("_uhost", "_upath", F.explode(F.filter("_ulens", lambda n: n <= F.length("_upath"))).alias("_ulen"))
             .select("_uhost", "_upath", F.expr("substring(_upath, 1, _ulen)").alias("_uouter")))
    outer = rules.select("_uhost", F.col("_upath").alias("_uouter"), "verdict")
    return (inner.join(outer, ["_uhost", "_uouter"])
            .groupBy("_uhost", "_upath")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_uouter").alias("path"), "verdict"))).alias("_ustack")))


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
          keep: list[str] | None = None) -> DataFrame:
    """Rows of ``urls`` (columns ``keep``, by default all) with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rule`` is null and ``verdict`` is ``default`` where no rule fits.
    """
    keep = [c for c in (urls.columns if keep is None else keep) if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col(url_col))
    rows = urls.select(*[F.col(c).alias(f"_uk{i}") for i, c in enumerate(keep)],
                       host.alias("_uhost"), path.alias("_upath"))
    # One verdict for each (host, path) of the rule table: block wins.
    rules = (rules.select(ascii_lower(F.col("host")).alias("_uhost"), F.coalesce("path", F.lit("")).alias("_upath"), "verdict")
             .where(F.col("_uhost").isNotNull() & F.col("verdict").isNotNull())
             .groupBy("_uhost", "_upath").agg(F.max("verdict").alias("verdict")))
    hosts = rules.groupBy("_uhost").agg(F.count("*").alias("_urules"))
    labels = rules.agg(F.max(F.size(F.split("_uhost", r"\.")))).scalar()  # the most labels of a rule host

    # A url once for each of its host suffixes that is a rule host.
    keys = (rows.select("_uhost", "_upath").where("_uhost != ''").distinct()
            .withColumn("_ulabels", labels)
            .withColumn("_uparts", F.split("_uhost", r"\."))
            .withColumn("_un", F.size("_uparts"))
            .select("_uhost", "_upath", F.explode(F.expr(
                "transform(sequence(greatest(1, _un - _ulabels + 1), _un),"
                " i -> array_join(slice(_uparts, i, _un - i + 1), '.'))")).alias("_ukey")))
    keys = keys.join(hosts.withColumnRenamed("_uhost", "_ukey"), "_ukey")

    # Cells: a rule host gets as many as its share of the urls asks for, bounded by urls per rule.
    spread = 4 * shuffle_partitions(urls.sparkSession)
    counts = keys.groupBy("_ukey", "_urules").agg(F.count("*").alias("_uurls"))
    total = counts.agg(F.sum("_uurls")).scalar()
    cells = (counts.withColumn("_utotal", total)
             .select("_ukey", F.greatest(F.lit(1), F.least(
                 F.ceil(F.lit(spread) * F.col("_uurls") / F.col("_utotal")),
                 F.floor(F.col("_uurls") / F.col("_urules")))).cast("int").alias("_ucells")))

    starts = (_stacks(rules).withColumnRenamed("_uhost", "_ukey").join(cells, "_ukey")
              .select("_ukey", F.explode(F.expr("sequence(0, _ucells - 1)")).alias("_ucell"),
                      "_upath", F.lit(0).alias("_ukind"), F.lit(None).cast("string").alias("_uhost"), "_ustack"))
    points = (keys.join(cells, "_ukey")
              .select("_ukey", F.expr("cast(pmod(xxhash64(_uhost, _upath), _ucells) as int)").alias("_ucell"),
                      "_upath", F.lit(1).alias("_ukind"), "_uhost", F.lit(None).cast(starts.schema["_ustack"].dataType).alias("_ustack")))

    # The sweep: in key order, the last rule started gives the stack; closed rules are popped.
    order = Window.partitionBy("_ukey", "_ucell").orderBy(
        F.concat(reversed_host(F.col("_ukey")), "_upath"), "_ukind").rowsBetween(Window.unboundedPreceding, 0)
    # Dealt by cell on purpose: the partitioning of the join above would put a rule host in one task.
    swept = (starts.unionByName(points).repartition("_ukey", "_ucell").withColumn("_uopen", F.last("_ustack", ignorenulls=True).over(order))
             .where("_ukind = 1")
             .withColumn("_ufit", F.filter("_uopen", lambda r: F.startswith(F.col("_upath"), r["path"])))
             .where("size(_ufit) > 0")
             .select("_uhost", "_upath", F.element_at("_ufit", -1).alias("_ulast"), "_ukey")
             .select("_uhost", "_upath", F.struct(
                 (F.length("_ukey") + F.length("_ulast.path")).alias("len"), F.length("_ukey").alias("host_len"),
                 F.concat("_ukey", "_ulast.path").alias("rule"), F.col("_ulast.verdict").alias("verdict")).alias("_ubest")))
    best = swept.groupBy("_uhost", "_upath").agg(F.max("_ubest").alias("_ubest"))
    return rows.join(best, ["_uhost", "_upath"], "left").select(
        *[F.col(f"_uk{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_uhost").alias("host"), F.col("_upath").alias("path"), F.col("_ubest.rule").alias("rule"),
        F.coalesce("_ubest.verdict", F.lit(default)).alias("verdict"))
