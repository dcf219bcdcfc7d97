"""URL allow and block rules by a sorted sweep over canonical keys.

A rule (host, path) fits a url when the url's host is the rule's host or a
subdomain of it and its path starts with the rule's path.  Hosts are reversed
label by label (``www.example.net`` becomes ``net.example.www.``), and the key
of a rule is reversed host plus path, so that a rule covers one interval of
keys, and intervals are nested or disjoint.  A url probes the sorted keys once
for each of its host's suffixes that has a rule.  The sweep goes over rules and
probes in key order: the last rule start at or before a probe carries the stack
of rules nested around it; the innermost one whose interval has not ended fits.

Built-in DataFrame functions only.  Sweeps run per host suffix; a suffix with
many urls (such as ``com.``) is cut by a hash of host and path into sweeps of
about ``rows_per_sweep`` urls, with its rules repeated in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.common import lower_ascii, small_or_shuffled

SEPARATOR = "://"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; else empty."""
    return F.when(F.instr(url, SEPARATOR) > 0,
                  lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; else empty."""
    return F.when(F.instr(url, SEPARATOR) > 0,
                  F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, SEPARATOR) + 3, F.length(url))


def _reversed(labels: Column) -> Column:
    """``labels`` (last ones of the host, in host order) as a canonical key: reversed, each with a dot."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("."))


def filter_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
                rows_per_sweep: int = 4096, max_broadcast: int = 100_000) -> DataFrame:
    """All rows and columns of ``urls`` plus ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has (host, path, verdict), hosts in lower case.  The longest
    fitting rule wins (host and path together; of equals the one with the
    longer host).  Of repeated rules with different verdicts ``block`` holds.
    Urls that no rule fits get ``default`` and a null rule.  A null url, or one
    without ``://``, has empty host and path.  Rules with a null field fit
    nothing.  Columns of ``urls`` named like a result column are replaced.
    """
    keyed = urls.drop("host", "path", "rule", "verdict").withColumns(
        {"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})

    labels = F.split("host", r"\.", -1)
    known = rules.dropna(subset=["host", "path", "verdict"]).groupBy("host", "path").agg(
        F.max("verdict").alias("verdict")).select(
        "path", "verdict", F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"),
        F.size(labels).alias("depth"), _reversed(labels).alias("suffix"))
    # Rules nested around each rule: the rules among its path's prefixes, outermost first.
    inner = known.withColumn("prefix", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda i: F.substring("path", F.lit(1), i)))).select(
        "suffix", F.col("path").alias("inner"), "prefix")
    around = inner.join(known.withColumnRenamed("path", "prefix"), ["suffix", "prefix"]).groupBy("suffix", "inner").agg(
        F.array_sort(F.collect_list(F.struct(F.length("prefix").alias("n"), F.col("prefix").alias("path"), "rule",
                                             "host_length", "verdict"))).alias("stack")).select(
        "suffix", F.col("inner").alias("path"), "stack")

    deepest = known.agg(F.max("depth")).first()[0] or 0
    hosts = small_or_shuffled(known.select("suffix").distinct(), max_broadcast)
    probes = (keyed.select("host", "path").distinct()
              .withColumn("labels", labels)
              .withColumn("k", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size("labels"), F.lit(deepest))))))
              .withColumn("suffix", _reversed(F.slice("labels", F.size("labels") - F.col("k") + 1, F.col("k"))))
              .drop("labels", "k").join(hosts, "suffix", "left_semi"))

    # At most one row per rule host, so it is hinted under the same bound as the hosts.
    cuts = probes.groupBy("suffix").agg(F.ceil(F.count("*") / rows_per_sweep).cast("int").alias("cuts"))
    cuts = small_or_shuffled(cuts, max_broadcast)
    probes = probes.join(cuts, "suffix").select(
        "suffix", F.pmod(F.xxhash64("host", "path"), F.col("cuts")).cast("int").alias("cut"), "path", "host",
        F.lit(1).alias("kind"), F.lit(None).cast(around.schema["stack"].dataType).alias("stack"))
    starts = around.join(cuts, "suffix").withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).select(
        "suffix", "cut", "path", F.lit(None).cast("string").alias("host"), F.lit(0).alias("kind"), "stack")

    sweep = Window.partitionBy("suffix", "cut").orderBy("path", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    fit = (probes.unionByName(starts).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
           .filter("kind = 1")
           .withColumn("top", F.expr("try_element_at(filter(stack, x -> startswith(path, x.path)), -1)"))
           .filter("top is not null")
           .groupBy("host", "path").agg(F.max(F.struct(
               F.length("top.rule").alias("n"), "top.host_length", "top.rule", "top.verdict")).alias("best")))
    return keyed.join(fit, ["host", "path"], "left").select(
        *[c for c in keyed.columns], F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
