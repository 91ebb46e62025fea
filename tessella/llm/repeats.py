"""Remove every byte covered by a string of ``length`` bytes that also starts anywhere else.

Anchors.  Each window of ``length`` bytes is known by the smallest hash among its ``GRAM``-byte
strings, the first of them on a tie: its anchor.  Equal windows have equal anchors at equal
places, so only windows with the same anchor are ever compared.  Windows in a row with one anchor
form a run; a run and the bytes it covers are one row, about one for each 70 bytes of text.

Runs whose anchor occurs once are done: nothing repeats.  Runs with equal bytes repeat each other
in whole.  The rest, whose anchors have other bytes around them elsewhere, is settled window by
window: the distinct contexts of a set of anchors are put in one byte string whose suffixes are
sorted to ``length`` bytes by bucket-pointer refinement.  Suffixes start in buckets by their
first bytes; a bucket is refined by sorting on the bucket identifiers of later offsets,
and what is refined is used at once by the next.  Windows left in one bucket are equal.

The side of a join that no key repeats in is written first, so that adaptive execution can split
the other side where a passage or a text has very many copies.  An anchor with over ``HOT_CONTEXTS`` distinct contexts does not go to one task: its windows become
rows and are counted by their digests.

Texts are told apart by 64-bit hashes, and anchors and contexts compared by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import Roller, give_back_memory, mix64, text_arrays, written

LENGTH = 200
GRAM = 64
#: Window starts per step of numpy work.
STEP = 1 << 19
#: Contexts that are sorted together in one task.
TASK_CONTEXTS = 4_000
HOT_CONTEXTS = 20_000

_PLACE = np.uint64((1 << 20) - 1)


def anchor_runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``start, count, offset, anchor, context`` of the runs of windows of one text: ``count``
    windows from ``start`` have their anchor at ``start + offset``."""
    parts = []
    span = length - gram + 1  # grams in a window
    for first in range(0, max(0, len(data) - length + 1), STEP):
        own = data[first : first + STEP + length - 1]
        windows = len(own) - length + 1
        rolled = Roller(own)
        grams = rolled.grams(gram)
        packed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        padded = np.full(-(-len(packed) // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(packed)] = packed
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
        at = (least & _PLACE).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        end = np.concatenate([start[1:], [windows]])
        offset = at[start] - start
        context = rolled.slices(start, end + length - 1)
        context = mix64(context ^ ((offset.astype(np.uint64) << np.uint64(20)) + (end - start).astype(np.uint64)))
        parts.append((start + first, end - start, offset, grams[at[start]], context))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _runs(batches):
    names = ["text_hash", "run", "anchor", "context"]
    for batch in batches:
        hashes = batch.column(0).to_numpy(zero_copy_only=False)
        for i in range(0, batch.num_rows, 200):
            data, offsets = text_arrays(batch.column(1).slice(i, 200))
            found = [anchor_runs(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            columns = [np.concatenate(x) for x in zip(*found)]
            owner = np.repeat(hashes[i : i + 200], [len(f[0]) for f in found])
            run = (columns[0] << 16) | (columns[2] << 8) | columns[1]
            arrays = [owner, run, columns[3].view(np.int64), columns[4].view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)
        give_back_memory()


def _unpacked(run: str) -> list:
    """``start, offset, count`` of a run held in one integer; the last two are below 256."""
    run = F.col(run)
    return [
        F.shiftright(run, 16).alias("start"), F.shiftright(run, 8).bitwiseAND(F.lit(255)).cast("int").alias("offset"),
        run.bitwiseAND(F.lit(255)).cast("int").alias("count"),
    ]


def refine(data: np.ndarray, end: np.ndarray, start: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Bucket identifiers of the suffixes of ``data``, cut at ``length`` bytes, by bucket-pointer
    refinement: suffixes are equal to that depth if and only if their identifiers are, for
    those whose ``length`` bytes end by ``end[i]``.  ``first`` tells apart suffixes that need
    not be compared; ``start`` marks those to be settled.
    """
    n = len(data)
    depth = 8
    codes = np.zeros(n, np.uint64)
    for j in range(depth):
        codes[: n - j] = (codes[: n - j] << np.uint64(8)) | data[j:]
    place = np.arange(n)
    whole = place + depth <= end
    bucket = -1 - place  # a suffix that is too short is alone
    _, ids = np.unique(codes[whole], return_inverse=True)
    bucket[whole] = ids
    active = place[whole]
    fresh = n
    while depth < length:
        step = min(depth, length - depth)
        # what is alone stays alone at every depth: only shared buckets are refined
        active = active[active + depth + step <= end[active]]
        if depth + step == length:
            active = active[start[active]]
        later = bucket[active + step]
        extra = first[active] if depth + step == length else np.zeros(len(active), np.int64)
        order = np.lexsort((extra, later, bucket[active]))
        b, r, x = bucket[active][order], later[order], extra[order]
        new = np.concatenate([[False], (b[1:] != b[:-1]) | (r[1:] != r[:-1]) | (x[1:] != x[:-1])])
        ids = np.cumsum(new) if len(order) else np.zeros(0, np.int64)
        # suffixes that do not reach the new depth are no longer compared with these
        bucket[active[order]] = fresh + ids
        fresh += int(ids[-1]) + 1 if len(ids) else 0
        size = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
        depth += step
        if depth < length:
            # a suffix alone in its bucket needs no more sorting, its identifier still serves others
            active = np.sort(active[order][size[ids] > 1])
    return bucket


def repeated_windows(contexts: list[bytes], anchors: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its windows equal a window of another of the same anchor at the
    same place."""
    sizes = np.array([len(c) for c in contexts])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    end = np.repeat(begin[1:], sizes)
    place = np.arange(len(data)) - np.repeat(begin[:-1], sizes)
    start = np.arange(len(data)) + length <= end
    _, anchor_ids = np.unique(anchors, return_inverse=True)
    first = np.repeat(anchor_ids, sizes) * (2 * length) + place - np.repeat(offsets, sizes) + length
    bucket = refine(data, end, start, first, length)
    ids, inverse, count = np.unique(bucket[start], return_inverse=True, return_counts=True)
    twice = np.zeros(len(data), bool)
    twice[start] = count[inverse] > 1
    return [twice[a : b - length + 1] for a, b in zip(begin[:-1], begin[1:])]


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[0::2], edges[1::2]


def _settle(group: pa.Table) -> pa.Table:
    anchors = group.column("anchor").to_numpy()
    contexts = group.column("context").to_numpy()
    flags = repeated_windows(group.column("bytes").to_pylist(), anchors, group.column("offset").to_numpy().astype(np.int64))
    out = [(a, c, s, e - s) for a, c, f in zip(anchors, contexts, flags) for s, e in zip(*_spans(f))]
    columns = list(zip(*out)) if out else [()] * 4
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("anchor", "context", "skip", "many"), columns, types)})


def repeated_runs(docs: DataFrame, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """``text_hash, start, count``: runs of window starts of ``docs (text_hash, text)`` that
    repeat.  A text in several rows repeats itself."""
    runs = docs.mapInArrow(_runs, "text_hash long, run long, anchor long, context long")
    shared = runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    runs = written(runs.join(written(shared, "anchors"), "anchor"), "runs")
    contexts = runs.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("text_hash", "run")).alias("at"))
    contexts = written(contexts, "contexts")
    whole = contexts.where("n > 1").select("anchor", "context", F.lit(0).alias("skip"), F.lit(None).cast("int").alias("many"))
    several = written(contexts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "several")
    open_ = contexts.join(several.select("anchor"), "anchor").select("anchor", "context", "at.text_hash", *_unpacked("at.run"))
    texts = docs.groupBy("text_hash").agg(F.first("text").alias("text"))
    raw = F.col("text").cast("binary")
    piece = F.substring(raw, (F.col("start") + 1).cast("int"), F.col("count") + (LENGTH - 1)).alias("bytes")
    pieces = open_.join(texts, "text_hash").select("anchor", "context", "offset", "count", piece)
    crowded = several.where(F.col("n") > hot_contexts).select("anchor")
    total = several.agg(F.sum("n")).first()[0] or 0
    if crowded.isEmpty():
        plain, windows = pieces, None
    else:
        crowded = written(crowded, "crowded")
        plain = pieces.join(crowded, "anchor", "left_anti")
        each = pieces.join(crowded, "anchor").select(
            "anchor", "context", (F.col("offset")).alias("offset"), "bytes", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("skip")
        )
        digest = F.md5(F.substring(F.col("bytes"), F.col("skip") + 1, F.lit(LENGTH)))
        each = each.select("anchor", "context", "skip", (F.col("skip") - F.col("offset")).alias("place"), digest.alias("digest"))
        twice = each.groupBy("anchor", "place", "digest").count().where("count > 1").drop("count")
        windows = each.join(twice, ["anchor", "place", "digest"]).select("anchor", "context", "skip", F.lit(1).alias("many"))
    tasks = max(1, -(-total // TASK_CONTEXTS))
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(tasks)).alias("bucket")
    settled = plain.select(bucket, "anchor", "context", "offset", "bytes").groupBy("bucket").applyInArrow(
        _settle, "anchor long, context long, skip int, many int"
    )
    parts = whole.union(settled)
    if windows is not None:
        parts = parts.union(windows)
    found = runs.join(written(parts, "parts"), ["anchor", "context"]).select("text_hash", "skip", "many", *_unpacked("run"))
    return found.select(
        "text_hash", (F.col("start") + F.col("skip")).alias("start"), F.coalesce("many", "count").alias("count")
    )


_CUT_TYPE = "struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept: binary>"


def _without(text: pa.Array, runs: pa.Array) -> pa.Array:
    out = []
    for t, r in zip(text, runs):
        raw = t.as_buffer() if t.is_valid else b""
        data = np.frombuffer(raw, np.uint8) if len(raw) else np.zeros(0, np.uint8)
        if not r.is_valid or not len(r):
            out.append((len(data), 0, 0, data.tobytes()))
            continue
        start = r.values.field("start").to_numpy(zero_copy_only=False)
        end = start + r.values.field("count").to_numpy(zero_copy_only=False) + LENGTH - 1
        steps = np.zeros(len(data) + 1, np.int64)
        np.add.at(steps, start, 1)
        np.add.at(steps, end, -1)
        gone = np.cumsum(steps[:-1]) > 0
        out.append((len(data), int(gone.sum()), len(_spans(gone)[0]), data[~gone].tobytes()))
    columns = list(zip(*out)) if out else [()] * 4
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    give_back_memory()
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", into: str = "cut", hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """``docs`` with ``into``: ``struct<n_bytes, n_removed, n_spans, kept>`` for every row.

    ``kept`` is the text's UTF-8 without each byte that is covered by a string of 200 bytes which
    starts anywhere else, in the same text or another row; strings overlap freely and are judged
    on the input.  So texts of 200 bytes or more that occur in two rows go in whole.  Null and
    empty texts, and texts under 200 bytes, keep what they have.  An empty table gives an empty
    result.  Other columns pass through, whatever their names.
    """
    hashed = docs.select(F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    runs = repeated_runs(hashed.where(F.octet_length("text") >= LENGTH), hot_contexts)
    # a text's runs are at most as many as its windows
    by_text = runs.groupBy("text_hash").agg(F.collect_set(F.struct("start", "count")).alias("_runs")).withColumnRenamed("text_hash", "_hash")
    by_text = written(by_text, "by-text")
    joined = docs.withColumn("_key", F.xxhash64(F.col(text))).join(by_text, F.col("_key") == F.col("_hash"), "left")
    return joined.withColumn(into, F.arrow_udf(_without, _CUT_TYPE)(F.col(text), F.col("_runs"))).drop("_key", "_hash", "_runs")
