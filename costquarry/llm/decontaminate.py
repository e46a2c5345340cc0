"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

A mask keeps some places of a window of tokens and ignores the others, so that a window still hashes
alike when tokens at ignored places are substituted. Hashes of all windows of all documents meet those
of the benchmark items; at each hit the item is laid over the document and equal tokens are counted.

A hit of an item of up to SEGMENT tokens takes the document's tokens under it along. Hits of longer items, and of
items that have a hash at several places, are reduced to distinct offsets first, then compared in segments of the
item, whose counts are added up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costquarry.llm.runtime import stage

MASKS = ("1101011", "110010101")
MIN_MATCHED = 12
MIN_SHARE = 0.6
#: Benchmark tokens up to which its hashes are sent to every executor; beyond it they are joined by a shuffle.
BROADCAST_TOKENS = 2_000_000
#: Item tokens that one row carries to be compared; longer items are compared in so many rows as they take.
SEGMENT = 256
#: Tasks that share the windows of one hash where seeds are not sent to every executor.
SALTS = 16


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def windows(df: DataFrame, words: str, keep: list[str], masks: tuple[str, ...] = MASKS) -> DataFrame:
    """A row for each window and mask that fits: keep, pos (from 0), key."""
    used = sorted({i for m in masks for i, c in enumerate(m) if c == "1"})
    n = F.size(words)
    shifted = [F.slice(words, F.lit(i + 1), F.greatest(n - i, F.lit(0))).alias(f"t{i}") if i else F.col(words).alias("t0") for i in used]
    at = df.select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "_w"))
    keys = []
    for k, m in enumerate(masks):
        places = [F.col("_w").getField(f"t{i}") for i, c in enumerate(m) if c == "1"]
        keys.append(F.when(places[-1].isNotNull(), F.xxhash64(F.lit(k), *places)))
    return at.select(*keep, "pos", F.explode(F.array(*keys)).alias("key")).where("key is not null")


def _under(words: Column, begin: Column, end: Column, start: Column) -> tuple[Column, Column]:
    """Of an item laid over a document's words from token `start`: first place, in begin..end of the item, that lies on the document, and the words from there on."""
    first = F.greatest(begin, -start)
    return first, F.slice(words, start + first + 1, F.greatest(F.least(end, F.size(words) - start) - first, F.lit(0)))


def _equal(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _by_hits(docs: DataFrame, items: DataFrame, seeds: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Rows (_i, _item, start, item_tokens, n) of items of up to SEGMENT tokens: a hit takes the words under the item along, so no document is shuffled."""
    start = (F.col("pos") - F.col("_ipos")).alias("start")
    hits = windows(docs, "_dw", ["_i", "_dw"], masks).join(F.broadcast(seeds), "key").select("_i", "_dw", "_item", "_n", start)
    first, part = _under(F.col("_dw"), F.lit(0), F.col("_n"), F.col("start"))
    hits = hits.select("_i", "_item", "start", first.alias("_b"), part.alias("_part")).join(F.broadcast(items), "_item")
    same = _equal(F.col("_part"), F.slice("_iw", F.col("_b") + 1, F.size("_part")))
    return hits.select("_i", "_item", "start", F.size("_iw").alias("item_tokens"), same.cast("long").alias("n"))


def _by_segments(docs: DataFrame, items: DataFrame, seeds: DataFrame, masks: tuple[str, ...], send: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Rows (_i, _item, start, item_tokens, n) of items of any length, by distinct offsets and segments. send: how small tables go to all executors; None: they don't."""
    docs = docs.withColumn("_mark", F.xxhash64("_dw"))
    start = (F.col("pos") - F.col("_ipos")).alias("start")
    found, on = windows(docs, "_dw", ["_i", "_mark"], masks), ["key"]
    if send is None:
        # A frequent window is dealt to SALTS tasks, each with the seeds of its hash.
        found = found.withColumn("_salt", F.pmod(F.xxhash64("_i", "_mark", "pos"), F.lit(SALTS)).cast("int"))
        seeds, on = seeds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["key", "_salt"]
    send = send or (lambda table: table)
    found = found.join(send(seeds), on).select(F.col("_i").alias("_j"), F.col("_mark").alias("_m"), "_item", "_n", start).distinct()
    laid = docs.join(found, F.col("_i").eqNullSafe(F.col("_j")) & (F.col("_mark") == F.col("_m")))
    # Segments of the item that lie on the document.
    lowest, highest = F.greatest(-F.col("start"), F.lit(0)), F.least(F.col("_n"), F.size("_dw") - F.col("start")) - 1
    laid = laid.withColumn("_k", F.explode(F.sequence((lowest / SEGMENT).cast("int"), (highest / SEGMENT).cast("int"))))
    first, part = _under(F.col("_dw"), F.col("_k") * SEGMENT, (F.col("_k") + 1) * SEGMENT, F.col("start"))
    laid = laid.select("_i", "_mark", "_item", "start", "_k", (first - F.col("_k") * SEGMENT).alias("_b"), part.alias("_part"))
    cut = items.select("_item", F.xxhash64("_iw").alias("_im"), F.size("_iw").alias("item_tokens"), "_iw",
        F.explode(F.sequence(F.lit(0), ((F.size("_iw") - 1) / SEGMENT).cast("int"))).alias("_k"))
    cut = cut.select("_item", "_im", "item_tokens", "_k", F.slice("_iw", F.col("_k") * SEGMENT + 1, F.lit(SEGMENT)).alias("_is"))
    same = _equal(F.col("_part"), F.slice("_is", F.col("_b") + 1, F.size("_part")))
    counted = laid.join(send(cut), ["_item", "_k"]).select("_i", "_mark", "_item", "_im", "start", "item_tokens", "_k", same.alias("n"))
    # A row that repeats gives each segment again.
    counted = counted.groupBy("_i", "_mark", "_item", "_im", "start", "item_tokens", "_k").agg(F.max("n").alias("n"))
    return counted.groupBy("_i", "_mark", "_item", "_im", "start", "item_tokens").agg(F.sum("n").alias("n")).select("_i", "_item", "start", "item_tokens", "n")


def contaminated(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text",
    masks: tuple[str, ...] = MASKS, min_matched: int = MIN_MATCHED, min_share: float = MIN_SHARE, broadcast_tokens: int = BROADCAST_TOKENS,
) -> DataFrame:
    """A row for each document and benchmark item that overlap: id, item id, item_tokens, matched_tokens, start, share.

    An overlap has at least min_matched equal tokens at one offset, or min_share of the item's tokens if
    those are fewer, over the whole item. The best offset is given, the first of equals. All
    places of a hash in an item count. An item shorter than every mask is found where all its tokens
    follow each other. Null and empty texts overlap nothing. Rows of one id (null ids too) count as one document;
    an id may be a struct. Texts are read whole, however long; an empty table of either kind gives no rows.
    Extra columns are not read.
    """
    items = benchmark.select(benchmark[item_col].alias("_item"), tokens(benchmark[item_text]).alias("_iw")).where(F.size("_iw") > 0)
    items = stage(items.distinct(), "items")
    size = items.agg(F.coalesce(F.sum(F.size("_iw")), F.lit(0))).first()[0]
    send = F.broadcast if size <= broadcast_tokens else None
    seeds = windows(items.withColumn("_n", F.max(F.size("_iw")).over(Window.partitionBy("_item"))), "_iw", ["_item", "_n"], masks)
    seeds = seeds.select("key", "_item", "_n", F.col("pos").alias("_ipos")).distinct()
    seeds = seeds.withColumn("_places", F.count(F.lit(1)).over(Window.partitionBy("key", "_item")))
    far = (F.col("_n") > SEGMENT) | (F.max("_places").over(Window.partitionBy("_item")) > 1)
    seeds = stage(seeds.withColumn("_far", far).drop("_places"), "seeds")
    docs = df.select(df[id_col].alias("_i"), tokens(df[text]).alias("_dw"))
    if size > broadcast_tokens:
        hits = _by_segments(docs, items, seeds, masks, send)
    else:
        hits = _by_hits(docs, items, seeds.where("not _far"), masks)
        if seeds.where("_far").limit(1).count():
            hits = hits.union(_by_segments(docs, items, seeds.where("_far"), masks, send))
    shortest = min(map(len, masks))
    for n in sorted(r.n for r in items.select(F.size("_iw").alias("n")).where(F.col("n") < shortest).distinct().collect()):
        few, whole = items.where(F.size("_iw") == n), ("1" * n,)
        seeds = windows(few.withColumn("_n", F.lit(n)), "_iw", ["_item", "_n"], whole).select("key", "_item", "_n", F.col("pos").alias("_ipos")).distinct()
        hits = hits.union(_by_segments(docs, few, seeds, whole, send) if size > broadcast_tokens else _by_hits(docs, few, seeds, whole))
    enough = F.least(F.lit(min_matched), F.ceil(F.col("item_tokens") * F.lit(min_share)).cast("int"))
    hits = hits.withColumn("least", F.when(F.col("item_tokens") < shortest, F.col("item_tokens")).otherwise(enough))
    best = hits.where("n >= least").groupBy("_i", "_item").agg(F.max(F.struct("n", (-F.col("start")).alias("back"), "item_tokens")).alias("best"))
    start, n = -F.col("best.back"), F.col("best.n")
    total = F.col("best.item_tokens")
    return best.select(F.col("_i").alias(id_col), F.col("_item").alias(item_col), total.cast("long").alias("item_tokens"),
        n.cast("long").alias("matched_tokens"), start.cast("long").alias("start"), F.round(n / total, 6).alias("share"))


def _oracle() -> str:
    """The same with all places of a key, and whole items laid at each offset."""
    parts = []
    for i, m in enumerate(MASKS):
        key = " || ' ' || ".join(f"w[p + {k + 1}]" for k, c in enumerate(m) if c == "1")
        for table, ident in (("d", "doc_id"), ("b", "item_id")):
            parts.append(f"k_{table}_{i} AS (SELECT DISTINCT {ident}, p, {key} AS key FROM (SELECT {ident}, w, unnest(range(len(w) - {len(m) - 1})) AS p FROM {table}))")
    union = " UNION ".join(f"SELECT doc_id, item_id, d.p - b.p AS start FROM k_d_{i} d JOIN k_b_{i} b USING (key)" for i in range(len(MASKS)))
    shortest = min(map(len, MASKS))
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark),
     {", ".join(parts)},
     s AS (SELECT doc_id, item_id, d.w AS dw, b.w AS bw, unnest(range(len(d.w) - len(b.w) + 1)) AS start FROM b JOIN d ON len(b.w) BETWEEN 1 AND {shortest - 1}),
     hits AS ({union} UNION SELECT doc_id, item_id, start FROM s WHERE dw[CAST(start + 1 AS BIGINT):CAST(start + len(bw) AS BIGINT)] = bw),
     laid AS (SELECT doc_id, item_id, start, len(b.w) AS item_tokens,
                     len(list_filter(range(len(b.w)), lambda k: start + k >= 0 AND start + k < len(d.w) AND d.w[CAST(start + k + 1 AS BIGINT)] = b.w[CAST(k + 1 AS BIGINT)])) AS n
              FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
     best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, start) AS place FROM laid
              WHERE n >= CASE WHEN item_tokens < {shortest} THEN item_tokens ELSE least({MIN_MATCHED}, ceil(item_tokens * {MIN_SHARE})) END)
SELECT doc_id, item_id, CAST(item_tokens AS BIGINT) AS item_tokens, CAST(n AS BIGINT) AS matched_tokens, CAST(start AS BIGINT) AS start,
round(n / item_tokens, 6) AS share FROM best WHERE place = 1
"""


ORACLE = _oracle()
