"""Language identification by a byte convolutional network trained in numpy.

Filters of several widths run over the bytes of a window; each filter's largest answer in the window is
pooled, and a softmax layer turns the pooled answers into shares of the languages. A text is cut into
windows of fixed length that cover all of it; its shares are the mean over its windows, by their bytes.
A score is the largest share times the share of the text's byte pairs that are ASCII or that the learned
texts have, as a net of a few languages places a text of any other script too.

As the input of a filter is one byte out of 256 at each place, a filter of width w is w tables of 256
entries; tables of two neighbouring places are joined to one of 65,536, so that a width takes w / 2
look-ups a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costquarry.llm import runtime

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE_ROWS = 2000  #: labelled rows that a model is fitted on, the first by hash of their id and text; all windows of their texts
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"


class Net(NamedTuple):
    labels: list[str]
    tables: dict[int, np.ndarray]  # width -> (width, 256, filters)
    bias: np.ndarray
    weight: np.ndarray  # (widths * filters, labels)
    offset: np.ndarray
    seen: np.ndarray  # of each pair of bytes, whether it is ASCII or a learned text has it


def windows(data: bytes, length: int = WINDOW) -> np.ndarray:
    """All bytes of a text as rows of a fixed length, the last filled up with zeros."""
    n = max(1, -(-len(data) // length))
    return np.frombuffer(data.ljust(n * length, b"\0"), np.uint8).reshape(n, length)


class Pools:
    """Pooled answers of all filters for a batch of windows."""

    def __init__(self, net: Net):
        self.net = net
        self.pairs = {w: [(t[i][:, None, :] + t[i + 1][None, :, :]).reshape(65536, -1) if i + 1 < w else t[i] for i in range(0, w,
            2)] for w, t in net.tables.items()}

    def __call__(self, x: np.ndarray) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        out = []
        for w, tables in self.pairs.items():
            n = x.shape[1] - w + 1
            answer = tables[0][pair[:, :n]]
            for k, t in enumerate(tables[1:], 1):
                answer += t[pair[:, 2 * k : 2 * k + n]] if 2 * k + 1 < w else t[x[:, 2 * k : 2 * k + n]]
            out.append(answer.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1) + self.net.bias, 0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 11) -> Net:
    """Fit by Adam on cross entropy; x: windows, y: place of the label. The same rows give the same net."""
    rng = np.random.default_rng(seed)
    n_pool = len(WIDTHS) * FILTERS
    p = {f"t{w}": rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {"bias": np.zeros(n_pool, np.float32), "weight": rng.normal(0, 0.2, (n_pool, len(labels))).astype(np.float32),
        "offset": np.zeros(len(labels), np.float32)}
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            xb, yb = x[order[i : i + batch]], y[order[i : i + batch]]
            at, best = {}, []
            for w in WIDTHS:
                n = x.shape[1] - w + 1
                answer = sum(p[f"t{w}"][j][xb[:, j : j + n]] for j in range(w))
                at[w] = answer.argmax(axis=1)
                best.append(np.take_along_axis(answer, at[w][:, None, :], 1)[:, 0])
            z = np.concatenate(best, axis=1) + p["bias"]
            h = np.maximum(z, 0)
            d = softmax(h @ p["weight"] + p["offset"])
            d[np.arange(len(yb)), yb] -= 1
            d /= len(yb)
            g = {"weight": h.T @ d, "offset": d.sum(axis=0)}
            dz = (d @ p["weight"].T) * (z > 0)
            g["bias"] = dz.sum(axis=0)
            for m, w in enumerate(WIDTHS):
                gt, part = np.zeros_like(p[f"t{w}"]), dz[:, m * FILTERS : (m + 1) * FILTERS]
                for j in range(w):
                    seen = np.take_along_axis(xb, at[w] + j, 1)
                    np.add.at(gt[j], (seen, np.arange(FILTERS)), part)
                g[f"t{w}"] = gt
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    seen = np.zeros(65536, bool)
    seen.reshape(256, 256)[:128, :128] = True
    seen[x[:, :-1].astype(np.int32) << 8 | x[:, 1:]] = True
    return Net(labels, {w: p[f"t{w}"] for w in WIDTHS}, p["bias"], p["weight"], p["offset"], seen)


def familiar(data: bytes, seen: np.ndarray) -> float:
    """The share of a text's byte pairs that are known."""
    b = np.frombuffer(data, np.uint8)
    return float(seen[b[:-1].astype(np.int32) << 8 | b[1:]].mean()) if len(b) > 1 else 1.0


def fit(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS) -> Net | None:
    """A net learned from the whole texts of at most `rows` labelled rows that may be learned from; None if there are none.

    Rows with a null id, text or label and rows that are held out teach nothing, nor do texts without a letter. A
    row is known by its id and text, so that one id may be on any number of rows; rows that repeat count once.
    """
    able = df.where(df[label].isNotNull() & df[id_col].isNotNull() & df[text].isNotNull() & ~runtime.held_out(df[id_col]))
    key = F.struct(df[id_col], F.xxhash64(df[text]))
    some = runtime.smallest_hashes(able, key, rows).select(df[label].alias("y"), df[text].alias("t"), F.xxhash64(key, F.lit(0)).alias("h"))
    got = some.dropDuplicates(["h", "y"]).orderBy("h", "y", "t").limit(rows).collect()
    got = [r for r in got if LETTER.search(r.t)]
    labels = sorted({r.y for r in got})
    if not labels:
        return None
    cut = [windows(r.t.encode()) for r in got]
    y = np.repeat([labels.index(r.y) for r in got], [len(c) for c in cut])
    x = np.concatenate(cut)
    del got, cut
    net = train(x, y, labels)
    runtime.tidy()
    return net


def predict(df: DataFrame, net: Net | None, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, `keep`, held_out, lang_pred and score (see above) for each row.

    A null text, or one without a letter, is `und` with score 0; so is every text if there is no net.
    Ties go to the label that comes first. All of a text is read, however long. Ids may be null or
    repeat, and an empty table gives no rows; columns not named are not read.
    """
    runtime.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pools = Pools(net) if net else None

        def shares(raw: list[bytes]) -> np.ndarray:
            out, todo = np.zeros((len(raw), len(net.labels))), [windows(r) for r in raw]
            owner = np.repeat(np.arange(len(raw)), [len(w) for w in todo])
            # A window counts by the bytes of the text in it.
            size = np.full(len(owner), WINDOW)
            size[np.cumsum([len(w) for w in todo]) - 1] = [len(r) - WINDOW * (len(w) - 1) for r, w in zip(raw, todo)]
            x = np.concatenate(todo)
            for first in range(0, len(x), 256):
                part = softmax(pools(x[first : first + 256]) @ net.weight + net.offset)
                np.add.at(out, owner[first : first + 256], part * size[first : first + 256, None])
            return out / np.bincount(owner, size, len(raw))[:, None]

        for b in runtime.slices(batches, read):
            texts = b.column(read).to_pylist()
            lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if net else []
            if known:
                raw = [texts[i].encode() for i in known]
                s = shares(raw)
                for i, r, k, v in zip(known, raw, s.argmax(axis=1), s.max(axis=1)):
                    lang[i], score[i] = net.labels[k], min(1.0, float(v)) * familiar(r, net.seen)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), b.column("_h"), pa.array(lang), pa.array(score)],
                [*names, "held_out", "lang_pred", "score"])
        runtime.tidy()

    names = list(dict.fromkeys([id_col, *keep]))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    # A text that is kept is sent to Python once.
    read = text if text in names else "_t"
    src = df.select(*(df[c] for c in names), *([] if text in names else [df[text].alias("_t")]), runtime.held_out(df[id_col]).alias("_h"))
    return src.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "held_out boolean, lang_pred string, score double"]))


def rejected(lang_pred: Column, score: Column, least: float = 0.5) -> Column:
    """Rows whose language is not determined: without a letter, without a language that has most of the text, or in none that was learned."""
    return (lang_pred == UNDETERMINED) | (score < least)
