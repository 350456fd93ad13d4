"""Secret candidates judged by who owns them across the whole corpus.

Patterns propose candidates. Each candidate's hash is counted over the corpus by
distinct owners and repositories: one that many share is a copied example, one
that a single owner holds looks live. The spans of the base patterns are always
reported; the spans of the wider patterns only where the candidate looks live.
Everything is native columns; only candidates, not texts, are shuffled.

NULL texts count as empty, a NULL owner or repository as one of its own. Rows are
kept apart even if their ids are equal or NULL. An empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.tables import let
from starloom.session import stage

#: kind -> (pattern, group of the value, least characters of the value). In this order.
#: Runs of one class are matched whole, so their least length can stand in the pattern.
BASE = {
    "assign": (
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
WIDER = {
    "prefixed": (r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-|AIza)[A-Za-z0-9_-]+", 0, 20),
    "mixed": (r"[A-Za-z0-9+/_-]{24,}", 0, 24),
}
KINDS = {**BASE, **WIDER}
#: What a text must hold for a kind to be looked for, where that is cheaper to ask.
HINTS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)",
    "access": "AKIA",
    "hex": r"[0-9a-f]{16}",
    "prefixed": r"gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-|AIza",
    "mixed": r"[A-Za-z0-9+/_-]{24}",
}
#: A candidate with more owners or more repositories than these is a copied example.
MAX_OWNERS, MAX_REPOS = 2, 4
_CHUNK = 512
REDACTED = "[SECRET]"


def _running(values: Column) -> Column:
    """Running totals of an array, chunk by chunk so that long arrays are not copied per item."""

    def totals(array: Column, start: Column) -> Column:
        begin = F.struct(start.alias("sum"), F.array().cast("array<long>").alias("out"))

        def add(acc: Column, x: Column) -> Column:
            sum_ = acc["sum"] + x
            return F.struct(sum_.alias("sum"), F.concat(acc["out"], F.array(sum_)).alias("out"))

        return F.aggregate(array, begin, add, lambda acc: acc["out"])

    def of(v: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(v), F.lit(_CHUNK))
        chunks = F.transform(firsts, lambda i: F.slice(v, i, _CHUNK))

        def joined(c: Column) -> Column:
            sums = F.transform(c, lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b))
            return let(
                totals(sums, F.lit(0).cast("long")),
                lambda after: F.flatten(
                    F.transform(c, lambda x, i: totals(x, F.coalesce(F.get(after, i - 1), F.lit(0).cast("long"))))
                ),
            )

        return let(chunks, joined)

    empty = F.array().cast("array<long>")
    return let(values, lambda v: F.when(F.size(v) == 0, empty).otherwise(of(v)))


def _hits(text: Column, kind: str, number: int) -> Column:
    """Spans and values of one kind; a span is counted in code points, its end exclusive.

    The text between matches and the matches themselves give every position.
    """
    pattern, group, least = KINDS[kind]
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )

    def spans(m: Column) -> Column:
        steps = F.transform(
            m["hits"], lambda h, i: (F.length(F.get(m["gaps"], i)) + F.length(h)).cast("long")
        )

        def placed(ends: Column) -> Column:
            all_ = F.transform(
                m["hits"],
                lambda h, i: F.struct(
                    (F.get(ends, i) - F.length(h)).alias("start"),
                    F.lit(number).alias("number"),
                    F.get(ends, i).alias("end"),
                    F.lit(kind).alias("kind"),
                    F.get(m["values"], i).alias("value"),
                ),
            )
            return F.filter(all_, lambda s: F.length(s["value"]) >= least)

        return let(_running(steps), placed)

    none = F.array().cast("array<struct<start:bigint,number:int,end:bigint,kind:string,value:string>>")
    return F.when(text.rlike(HINTS[kind]), let(parts, spans)).otherwise(none)


def _varied(value: Column) -> Column:
    """Whether a long word mixes digits, small and capital letters, as generated keys do."""
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def _key(value: Column) -> Column:
    return F.xxhash64(value, F.lit(1)).bitwiseXOR(F.crc32(value.cast("binary")))


def candidates(
    docs: DataFrame, id_col: str, text_col: str, owner: Column, repo: Column
) -> DataFrame:
    """Per document its candidates of all kinds, ordered by start, then kind as listed."""
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
    )
    kinds = [_hits(F.col("text"), k, n) for n, k in enumerate(KINDS)]
    kinds[-1] = F.filter(kinds[-1], lambda s: _varied(s["value"]))
    all_ = F.array_sort(F.concat(*kinds))
    found = F.transform(
        all_,
        lambda s: F.struct(
            F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("span"),
            s["kind"].alias("kind"),
            _key(s["value"]).alias("key"),
        ),
    )
    return own.withColumn("found", found)


def ownership(found: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Distinct owners and repositories of every candidate, and whether it looks live.

    Copies are counted once per owner and repository before anything is shuffled by
    candidate, so a candidate that a third of all rows hold is a few rows by then.
    """
    held = found.select(F.explode(F.array_distinct(F.transform("found", lambda s: s["key"]))).alias("key"), "owner", "repo")
    once = held.groupBy("key", "owner", "repo").agg(F.count(F.lit(1)).alias("n_docs"))
    per_owner = once.groupBy("key", "owner").agg(F.count(F.lit(1)).alias("n_repos"), F.sum("n_docs").alias("n_docs"))
    return per_owner.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("n_repos").alias("n_repos"), F.sum("n_docs").alias("n_docs")
    ).withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))


def _live_keys(found: DataFrame, owned: DataFrame, by: str) -> DataFrame:
    """Per document the keys of its candidates that look live."""
    live = owned.where("live").select("key")
    held = found.select(by, F.explode(F.array_distinct(F.transform("found", lambda s: s["key"]))).alias("key"))
    return held.join(live, "key").groupBy(by).agg(F.collect_set("key").alias("live_keys"))


def _judged(docs: DataFrame, id_col: str, text_col: str, owner: Column, repo: Column) -> DataFrame:
    """Documents with their candidates and the keys among them that look live."""
    rows = candidates(docs, id_col, text_col, owner, repo).select("doc_id", "owner", "repo", "found")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "secrets")
    with_any = rows.where(F.size("found") > 0)
    joined = rows.join(_live_keys(with_any, ownership(with_any), "row"), "row", "left")
    return joined.withColumn("live_keys", F.coalesce("live_keys", F.array().cast("array<long>")))


def scan(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, spans and the verdict of every document's candidates."""

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    def joined(keep: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(F.filter("found", keep), lambda s: s["span"]), ",")

    def live(s: Column) -> Column:
        return F.array_contains(F.col("live_keys"), s["key"])

    base = lambda s: s["kind"].isin(*BASE)
    return _judged(docs, id_col, text_col, owner, repo).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(lambda s: base(s) | live(s)).alias("spans"),
        F.size(F.filter("found", live)).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~live(s))).cast("long").alias("n_copied"),
    )


def redact(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every candidate that looks live replaced; copied examples stay.

    Live values are found again in the text, kind by kind. Only texts that hold a
    candidate are joined, by their digest; all others are passed on as they are.
    """
    hinted = F.coalesce(F.col(text_col).rlike("|".join(HINTS.values())), F.lit(False))
    some = docs.where(hinted)
    rows = candidates(some, id_col, text_col, owner, repo).withColumn("digest", F.md5(F.col("text").cast("binary")))
    found = stage(rows.select("digest", "owner", "repo", "found").where(F.size("found") > 0), "secrets")
    once = found.groupBy("digest").agg(F.any_value("found").alias("found"))
    keys = _live_keys(once, ownership(found), "digest").toDF("__digest", "__live")
    digest = F.md5(F.col(text_col).cast("binary"))
    joined = some.withColumn("__digest", digest).join(keys, "__digest", "left")
    text = F.col(text_col)
    patterns = [p for p, _, _ in KINDS.values()]

    def cleaned(pattern: str, group: int, value: Column) -> Column:
        def parts(v: Column) -> Column:
            return F.struct(
                F.split(v, pattern, -1).alias("gaps"),
                F.regexp_extract_all(v, F.lit(pattern), F.lit(0)).alias("hits"),
                F.regexp_extract_all(v, F.lit(pattern), F.lit(group)).alias("values"),
            )

        def rebuilt(m: Column) -> Column:
            shown = F.transform(
                m["gaps"],
                lambda gap, i: F.concat(
                    gap,
                    F.coalesce(
                        F.when(F.array_contains(F.col("__live"), _key(F.get(m["values"], i))), F.lit(REDACTED)).otherwise(
                            F.get(m["hits"], i)
                        ),
                        F.lit(""),
                    ),
                ),
            )
            return F.array_join(shown, "")

        # the text so far is itself the outcome of the kind before: it is made once
        return let(let(value, parts), rebuilt)

    clean = text
    for pattern, (_, group, _) in zip(patterns, KINDS.values()):
        clean = cleaned(pattern, group, clean)
    changed = F.when(F.col("__live").isNotNull(), clean).otherwise(text)
    return joined.withColumn(text_col, changed).select(*docs.columns).unionByName(docs.where(~hinted))
