"""Secrets in texts, with corpus-wide ownership: DataFrame functions only.

Method. Three base kinds are found by fixed patterns. Further candidates come from wider patterns
(provider tokens, keyed values of other names, long mixed runs). The hash of every candidate's value
is aggregated over the corpus to its numbers of distinct repositories and owners: a value that several
owners have, or that lies in more than ``REPOSITORIES`` repositories an owner, is a widely copied example;
one that stays with ``OWNERS`` owners or fewer and in few of their repositories is live-looking if it is of a
base kind or looks random: as many different characters as random values of its alphabet and length have. Live-looking wider candidates add their spans; base spans stay whatever their owners.

Results. One row per input row. Positions count code points from 0, ends exclusive. A null or blank
text has no spans. A null owner or repository counts as one owner or repository. Rows with the same
id are scanned each on their own; equal rows count as one repository. An empty table gives no rows;
extra columns are not read. Values are compared and shuffled as hashes only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyqa.llm.storage import shared_folder, staged

#: A value with at most so many owners, and repositories an owner, is not widely copied. A wider value looks
#: random with at least as many different characters as a random one of its length and alphabet has, less
#: so many standard deviations.
OWNERS, REPOSITORIES, DEVIATIONS = 2, 10, 3.0
#: Kinds in their order: pattern, group that holds the value, least characters of it. The least length
#: of the first kind is tested after matching, as a short match still takes its text.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 0),
    "hex": (r"[0-9a-f]{16,}", 0, 0),
}
WIDER = {
    "provider": (r"(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})", 0, 0),
    "keyed": (r"""(?i:auth|bearer|credential|private_?key|access_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 16),
    "mixed": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{24,}", 0, 0),
}


KINDS = list(BASE | WIDER)


def alphabet(value: str) -> str:
    """SQL of the number of characters that a value's are drawn from: digits, hexadecimal ones, or the classes it has."""
    classes = " + ".join(f"if({value} rlike '{c}', {n}, 0)" for c, n in (("[0-9]", 10), ("[a-z]", 26), ("[A-Z]", 26), ("[^0-9a-zA-Z]", 6)))
    return f"CASE WHEN {value} rlike '^[0-9]+$' THEN 10 WHEN {value} rlike '^([0-9a-f]+|[0-9A-F]+)$' THEN 16 ELSE {classes} END"


#: Mean and variance of the different characters of a random value: ``long`` characters out of ``alphabet``.
MISSING, BOTH = "power(1 - 1D / alphabet, long)", "power(greatest(0D, 1 - 2D / alphabet), long)"
EXPECTED = f"alphabet * (1 - {MISSING})"
VARIANCE = f"greatest(0D, alphabet * (alphabet - 1) * {BOTH} + alphabet * {MISSING} - pow(alphabet * {MISSING}, 2))"


def matches(kind: str, pattern: str, group: int) -> str:
    """SQL of a kind's matches: number, characters since the match before, own length, value's features."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return f"""
        if(text rlike '{quoted}',
            transform(
                arrays_zip(slice(split(text, '{quoted}'), 1, size(regexp_extract_all(text, '{quoted}', 0))),
                           regexp_extract_all(text, '{quoted}', 0), regexp_extract_all(text, '{quoted}', {group})),
                (x, k) -> named_struct(
                    'kind', {KINDS.index(kind)}, 'k', k, 'gap', length(x['0']), 'size', length(x['1']), 'long', length(x['2']),
                    'hash', xxhash64(x['2']), 'different', size(array_distinct(split(x['2'], ''))), 'alphabet', {alphabet("x['2']")})),
            cast(array() AS array<struct<kind: int, k: int, gap: int, size: int, long: int, hash: bigint, different: int, alphabet: int>>))
    """


def found(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str, keep: list[str]) -> DataFrame:
    """Every row with a number of its own, owner, repository and the matches of all kinds."""
    named = docs.select(
        *keep, F.col(id_col).alias("_id"), F.col(owner_col).cast("string").alias("_owner"),
        F.col(repository_col).cast("string").alias("_repository"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("_row", F.monotonically_increasing_id())
    every = ", ".join(matches(kind, pattern, group) for kind, (pattern, group, _) in (BASE | WIDER).items())
    return named.withColumn("_hits", F.expr(f"concat({every})")).drop("text")


def judged(hits: DataFrame) -> DataFrame:
    """One row per span: row, kind, start, end, and whether its value is live-looking.

    Positions are running sums over a row's matches; ownership is counted over all rows.
    """
    upto = Window.partitionBy("_row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    spans = hits.filter("size(_hits) > 0").select("_row", "_owner", "_repository", F.explode("_hits").alias("h")).select(
        "_row", "_owner", "_repository", "h.*"
    ).withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    least = F.element_at(F.array(*[F.lit(x[2]) for x in (BASE | WIDER).values()]), F.col("kind") + 1)
    spans = spans.filter(F.col("long") >= least)
    owners = spans.groupBy("hash", "_owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("owners"))
    repositories = spans.groupBy("hash", "_repository").agg(F.count("*").alias("n")).groupBy("hash").agg(
        F.count("*").alias("repositories")
    )
    few = (F.col("owners") <= OWNERS) & (F.col("repositories") <= REPOSITORIES * F.col("owners"))
    random = F.expr(f"different >= {EXPECTED} - {DEVIATIONS}D * sqrt({VARIANCE})")
    live = few & ((F.col("kind") < len(BASE)) | random)
    return spans.join(owners.join(repositories, "hash"), "hash").select(
        "_row", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "owners", "repositories", live.alias("live")
    )


def collected(spans: DataFrame) -> DataFrame:
    """Spans per row in order of start and kind: base ones, and live-looking wider ones apart from kinds before."""
    wider = F.col("kind") >= len(BASE)
    spans = spans.filter(~wider | F.col("live"))
    rows = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live", "owners", "repositories"))).alias("all"))
    base = F.expr(f"filter(all, x -> x.kind < {len(BASE)})")
    return rows.withColumn("base", base).withColumn(
        "all", F.expr(f"filter(all, x -> x.kind < {len(BASE)} OR NOT exists(all, b -> b.kind < x.kind AND x.start < b.end AND x.end > b.start))")
    )


def joined(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), x.start, x.end)), ',')")


def secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id"
) -> DataFrame:
    """Counts of base kinds, their digest and all spans of every row, with owners and repositories of each span's value."""
    hits = staged(found(docs, id_col, text_col, owner_col, repository_col, []), shared_folder(docs.sparkSession), "hits")
    rows = hits.select("_row", "_id").join(collected(judged(hits)), "_row", "left")
    count = lambda k: F.expr(f"coalesce(size(filter(base, x -> x.kind = {k})), 0)").cast("long")
    empty = F.lit("")
    return rows.select(
        F.col("_id").alias("doc_id"), *[count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        F.sha2(F.coalesce(joined("base"), empty), 256).alias("base_sha256"), F.coalesce(joined("all"), empty).alias("spans"),
        F.expr("coalesce(size(filter(all, x -> x.live)), 0)").cast("long").alias("n_live"),
        F.expr("coalesce(size(filter(all, x -> NOT x.live)), 0)").cast("long").alias("n_example"),
        F.coalesce(F.expr("array_join(transform(all, x -> concat_ws(':', x.owners, x.repositories)), ',')"), empty).alias("copies"),
    )


def redacted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id",
    mark: str = "[SECRET]",
) -> DataFrame:
    """``docs`` with every live-looking span replaced by ``mark``; rows without one are not shuffled."""
    kept = [c for c in docs.columns]
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)])
    column = dict(zip(kept, named.columns))
    hits = staged(
        found(named, column[id_col], column[text_col], column[owner_col], column[repository_col], named.columns),
        shared_folder(docs.sparkSession), "hits",
    )
    spans = collected(judged(hits)).select("_row", F.expr("filter(all, x -> x.live)").alias("live")).filter("size(live) > 0")
    text = column[text_col]
    shown = F.expr(f"""
        aggregate(live, named_struct('at', 0, 'out', ''), (s, x) -> named_struct(
            'at', greatest(s.at, cast(x.end AS int)),
            'out', if(x.start >= s.at, concat(s.out, substring({text}, s.at + 1, cast(x.start AS int) - s.at), '{mark}'), s.out)),
            s -> concat(s.out, substring({text}, s.at + 1)))
    """)
    some = hits.filter("size(_hits) > 0").join(spans, "_row", "left").withColumn(
        text, F.when(F.col("live").isNotNull(), shown).otherwise(F.col(text))
    )
    return hits.filter("size(_hits) = 0").select(*named.columns).union(some.select(*named.columns)).toDF(*kept)
