"""Secrets in text, and the weaker parts of credentials that show only beside each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import packed, unpacked

_LINK = r"""["']?\x20*[:=]\x20*["']?"""

#: Kind, pattern, the group whose length counts, the lengths that pass, and what the part is.
#: Where only runs of some length pass, the pattern asks for it: such a match is the whole run.
#: Every repeat that may fail after it is bounded, so that the work grows with the text alone; a
#: scheme has at most 32 characters for that.
BASE = (
    ("assign", rf"(?i:(password|passwd|secret|token|api_?key)){_LINK}([A-Za-z0-9+/_.=-]+)", 2, "n >= 8", "secret"),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, "n >= 16", "name"),
    ("hex", r"[0-9a-f]{32,}", 0, "n >= 32", "secret"),
)
WEAK = (
    ("user", rf"(?i:(access_?key_?id|client_?id|user_?name|user|login)){_LINK}([A-Za-z0-9_.@-]+)", 2, "n >= 3", "name"),
    ("key", r"[A-Za-z0-9+/]{40,}", 0, "n = 40", "secret"),
    ("endpoint", r"[a-z][a-z0-9+.-]{0,31}://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+", 0, "n >= 8", "endpoint"),
)
KINDS = BASE + WEAK

#: Parts belong together when at most so many code points lie between them.
SCOPE = 200
MASK = "[removed]"
#: Code points of the blocks that a text is cut into before spans are taken out of it.
_BLOCK = 4096


def _matches(text: Column, pattern: str, group: int) -> Column:
    """``(gap, n, size)`` of each match: code points before it since the last, counted, whole."""
    pat = F.lit(pattern)
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, pat, F.lit(0))
    counted = F.regexp_extract_all(text, pat, F.lit(group)) if group else whole
    lengths = lambda parts: F.transform(parts, lambda x: F.char_length(x).cast("long"))
    zipped = F.arrays_zip(
        F.slice(lengths(gaps), F.lit(1), F.size(whole)).alias("gap"),
        lengths(counted).alias("n"),
        lengths(whole).alias("size"),
    )
    return F.when(text.rlike(pattern), zipped)


def candidate_parts(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, kind, rank, role, start, end)`` of all base and weak parts.

    ``th`` is ``xxhash64`` of the text; rows that repeat both give their parts once. Lengths
    alone leave the scan, and a running sum turns them into places.
    """
    text = F.coalesce("text", F.lit(""))
    kinds = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.lit(rank).alias("rank"),
            F.lit(role).alias("role"),
            _matches(text, pattern, group).alias("found"),
        )
        for rank, (kind, pattern, group, _, role) in enumerate(KINDS)
    ]
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.filter(F.array(*kinds), lambda k: k.found.isNotNull()).alias("k"))
    rows = rows.where(F.size("k") > 0).dropDuplicates(["doc_id", "th"])
    rows = rows.select("doc_id", "th", F.explode("k").alias("k")).select(
        "doc_id", "th", "k.kind", "k.rank", "k.role", F.posexplode("k.found").alias("i", "m")
    )
    so_far = Window.partitionBy("doc_id", "th", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(so_far)
    rows = rows.select("doc_id", "th", "kind", "rank", "role", "m.n", (end - F.col("m.size")).alias("start"), end.alias("end"))
    passes = " OR ".join(f"(kind = '{kind}' AND {length})" for kind, _, _, length, _ in KINDS)
    return rows.where(passes).drop("n")


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base parts, and the weak ones that parts which complete them lie close to.

    A weak name needs a secret within ``scope`` code points, a weak secret a name, an endpoint
    both. Only whether some part lies in the scope counts, so the interval join is a sweep
    along each text: the furthest end before a part and the next start after it decide, and no
    pairs arise. A weak part that overlaps a base one is that one's, and is not reported.
    """
    text = Window.partitionBy("doc_id", "th")
    order = ["start", "rank", "end"]
    before = text.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Backwards, as a frame that reaches to the end would be gone through again for each row.
    after = text.orderBy(*map(F.desc, order)).rowsBetween(Window.unboundedPreceding, -1)

    def gap(which: Column) -> Column:
        back = F.col("start") - F.max(F.when(which, F.col("end"))).over(before)
        ahead = F.min(F.when(which, F.col("start"))).over(after) - F.col("end")
        return F.coalesce(F.least(back, ahead), F.lit(2**40))

    base = F.col("rank") < len(BASE)
    near = parts.select(
        "*",
        gap(base).alias("to_base"),
        gap(F.col("role") == "secret").alias("to_secret"),
        gap(F.col("role") == "name").alias("to_name"),
    )
    name, secret = F.col("to_name") <= scope, F.col("to_secret") <= scope
    complete = F.when(F.col("role") == "name", secret).when(F.col("role") == "secret", name).otherwise(name & secret)
    return near.where(base | (F.col("to_base") >= 0) & complete).drop("to_base", "to_secret", "to_name")


def spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(doc_id, th, spans)`` of documents with any: structs in order of start and kind."""
    parts = linked_parts(candidate_parts(docs), scope)
    span = F.struct("start", "rank", "end", "kind")
    return parts.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def _joined(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    return F.array_join(F.coalesce(each, F.array().cast("array<string>")), ",")


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked)`` per row."""
    found = spans(docs, scope).select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), "spans")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"))
    rows = rows.join(found, rows["doc_id"].eqNullSafe(found["_doc"]) & (rows["th"] == found["_th"]), "left")

    def number(test: str) -> Column:
        return F.when(F.col("spans").isNull(), 0).otherwise(F.expr(f"size(filter(spans, s -> {test}))")).cast("long")

    counts = [number(f"s.kind = '{kind}'").alias(f"n_{kind}") for kind, *_ in BASE]
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        number(f"s.rank >= {len(BASE)}").alias("n_linked"),
    )


def redact(docs: DataFrame, scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """The documents with every span in ``text`` replaced (``n_chars`` follows, if there).

    Spans that overlap or touch become one. The text is cut into blocks once, so that the work
    grows with its length and not with its length times its spans.
    """
    parts = linked_parts(candidate_parts(docs), scope)
    along = Window.partitionBy("doc_id", "th").orderBy("start", "end")
    furthest = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("start") > furthest).cast("int"), F.lit(1))
    islands = parts.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(along))
    islands = islands.groupBy("doc_id", "th", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = islands.groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts")
    )
    rows = packed(docs)
    same = rows["id"].eqNullSafe(cuts["_doc"]) & (rows["hash"] == cuts["_th"])
    rows = rows.join(cuts.hint("shuffle_hash"), same, "left").select("row", "_cuts")
    blocks = F.regexp_extract_all("row.text", F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    bounds = F.expr(
        "zip_with(concat(array(0L), _cuts.end), concat(_cuts.start, array(CAST(char_length(row.text) AS LONG))),"
        " (a, b) -> named_struct('a', a, 'b', b))"
    )
    pieces = F.expr(
        f"""transform(_bounds, x -> substring(
            array_join(slice(_blocks, CAST(x.a div {_BLOCK} + 1 AS INT), CAST(x.b div {_BLOCK} - x.a div {_BLOCK} + 1 AS INT)), ''),
            CAST(x.a % {_BLOCK} + 1 AS INT), CAST(x.b - x.a AS INT)))"""
    )
    rows = rows.withColumn("_blocks", F.when(F.col("_cuts").isNotNull(), blocks)).withColumn("_bounds", bounds)
    text = F.when(F.col("_cuts").isNull(), F.col("row.text")).otherwise(F.array_join(pieces, mask))
    return unpacked(rows, docs, text)
