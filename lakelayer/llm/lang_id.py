"""Word-level language identification with a linear-chain conditional random field.

A word's emission score per language is the sum of the weights of its hashed features: prefixes and suffixes of up to
four characters, character bi- and trigrams, the word itself, and the languages whose lexicon holds it. Learned
transitions join neighbouring words, so text that switches language is labelled word by word; forward-backward gives
each word's posterior. A document's language is the one with the largest mean posterior, which is its score.

The model is fitted on the driver from a bounded sample (documented in ``fit``): whole segments of words from labelled
rows, chosen by a hash. Everything else is a scan: documents are labelled where they lie, with no shuffle, the model
being a few hundred kilobytes. Emissions are cached per distinct word; sequences run through forward-backward as one
array operation per word position over many documents of like length.

Defined results: null text, or text without a letter, is ``und`` with score 0; languages never seen in training cannot
be predicted; with no labelled rows at all every document is ``und``; ties go to the first language in sorted order;
repeated rows get the same answer; other columns are not read (or pass through ``label`` untouched).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakelayer.llm.common import col, small_batches, text_or_empty

BUCKETS = 1 << 16
UNKNOWN = "und"
_TABLE = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters a-z and non-ASCII characters; none if the text has no letter at all."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()
    if words and not any(w.isalpha() for w in words) and not any(c.isalpha() for c in text):
        return []
    return words


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h + np.uint64(kind)) * _MIX[0]
    h ^= h >> np.uint64(29)
    h *= _MIX[1]
    return (h >> np.uint64(48)).astype(np.int64) % BUCKETS


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hashed feature number) of all features of distinct words: the word, prefixes and suffixes of one
    to four characters, and character bi- and trigrams over its edges."""
    text = b" " + b" ".join(words) + b" "
    c = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    gaps = np.flatnonzero(c == 32)
    start, length = gaps[:-1] + 1, np.diff(gaps) - 1
    who = np.arange(len(words))
    w = np.repeat(who, length)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    at = np.repeat(start, length) + inside
    power = _MIX[2] ** (np.arange(int(length.max()) + 1, dtype=np.uint64) + np.uint64(1))
    whole = np.add.reduceat(c[at] * power[inside], np.cumsum(length) - length)
    out = [(who, _bucket(whole, 1))]
    two = c[:-1] * _MIX[2] + c[1:] * _MIX[3]
    three = two[:-1] + c[2:] * _MIX[1]
    out += [(w, _bucket(two[at], 2)), (who, _bucket(two[start - 1], 2)), (w, _bucket(three[at - 1], 3))]
    head = np.zeros(len(words), np.uint64)
    tail = np.zeros(len(words), np.uint64)
    for k in range(4):
        has = length > k
        head[has] = head[has] * _MIX[2] + c[start[has] + k]
        tail[has] = tail[has] * _MIX[2] + c[start[has] + length[has] - 1 - k]
        out += [(who[has], _bucket(head[has], 10 + k)), (who[has], _bucket(tail[has], 20 + k))]
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def forward_backward(emit: np.ndarray, length: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """Posteriors (time, sequence, label) and log-likelihood normalisers of padded sequences, and the summed posterior
    of label pairs. ``emit`` is (time, sequence, label) of scores."""
    steps, lanes, k = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e = np.exp(emit - top)
    a = np.empty_like(e)
    scale = np.ones((steps, lanes))
    m, start = np.exp(trans), np.exp(first)
    alive = np.arange(steps)[:, None] < length[None, :]
    cur = start * e[0]
    for t in range(steps):
        if t:
            nxt = (cur @ m) * e[t]
            cur = np.where(alive[t][:, None], nxt, cur)
        s = np.where(alive[t], cur.sum(axis=1), 1.0)
        cur = cur / s[:, None]
        scale[t] = s
        a[t] = cur
    post = np.empty_like(e)
    pairs = np.zeros((k, k))
    b = np.ones((lanes, k))
    post[-1] = a[-1]
    for t in range(steps - 1, 0, -1):
        live = alive[t][:, None]
        eb = e[t] * b / scale[t][:, None]
        pairs += m * (np.where(live, a[t - 1], 0).T @ np.where(live, eb, 0))
        b = np.where(live, eb @ m.T, b)
        post[t - 1] = a[t - 1] * b
    logz = np.where(alive, np.log(scale) + top[:, :, 0], 0).sum(axis=0)
    return post, logz, pairs


class Crf:
    """Feature weights, lexicon, transitions and the label order."""

    def __init__(self, labels: list[str], lexicon: dict[bytes, list[int]]):
        k = len(labels)
        self.labels, self.lexicon = labels, lexicon                 # lexicon: word -> numbers of its labels
        self.weights = np.zeros((BUCKETS + k, k))
        self.trans, self.first = np.eye(k) * 0.5, np.zeros(k)

    def features(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``word_features``, and one feature for each language whose lexicon holds the word."""
        who, feature = word_features(words)
        held = [self.lexicon.get(w, ()) for w in words]
        at = np.repeat(np.arange(len(words)), [len(x) for x in held])
        rows = np.array([BUCKETS + y for x in held for y in x], np.int64)
        return np.concatenate([who, at]), np.concatenate([feature, rows])

    def emissions(self, words: list[bytes]) -> np.ndarray:
        who, feature = self.features(words)
        return np.stack([np.bincount(who, self.weights[feature, c], len(words)) for c in range(len(self.labels))], axis=1)

    def train(self, segments: list[tuple[list[bytes], int]], rounds: int, batch: int, rate: float, l2: float) -> None:
        """Adagrad ascent of the conditional likelihood of the segments' word labels (all words of a segment share
        the label; its learned transitions come from segments joined in pairs)."""
        vocab: dict[bytes, int] = {}
        seqs = [(np.array([vocab.setdefault(w, len(vocab)) for w in words]), np.full(len(words), y))
                for words, y in segments]
        who, flat = self.features(list(vocab))
        flat = flat[np.argsort(who, kind="stable")]
        n = np.bincount(who, minlength=len(vocab))
        at = np.concatenate([[0], np.cumsum(n)])
        k = len(self.labels)
        rng = np.random.default_rng(7)
        grad_sq, tr_sq, st_sq = np.full_like(self.weights, 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
        for _ in range(rounds):
            order = rng.permutation(len(seqs))
            for s in range(0, len(order), batch):
                picked = [seqs[i] for i in order[s:s + batch]]
                # two neighbours of the shuffled order make one sequence: the switch between them is what transitions see
                joined = [tuple(np.concatenate(x) for x in zip(*picked[i:i + 2])) for i in range(0, len(picked), 2)]
                length = np.array([len(x) for x, _ in joined])
                steps, lanes = int(length.max()), len(joined)
                uniq, inv = np.unique(np.concatenate([x for x, _ in joined]), return_inverse=True)
                m = n[uniq]
                own = np.concatenate([flat[at[u]:at[u + 1]] for u in uniq])
                em = np.add.reduceat(self.weights[own], np.concatenate([[0], np.cumsum(m)[:-1]]), axis=0)
                lane = np.repeat(np.arange(lanes), length)
                time = np.concatenate([np.arange(x) for x in length])
                emit = np.zeros((steps, lanes, k))
                emit[time, lane] = em[inv]
                post, _, pairs = forward_backward(emit, length, self.trans, self.first)
                y = np.concatenate([z for _, z in joined])
                diff = -post[time, lane]
                diff[np.arange(len(y)), y] += 1
                per_word = np.stack([np.bincount(inv, diff[:, c], len(uniq)) for c in range(k)], axis=1)
                g = np.zeros_like(self.weights)
                rows = np.repeat(per_word, m, axis=0)
                for c in range(k):
                    g[:, c] = np.bincount(own, rows[:, c], len(g))
                g = g / len(y) - l2 * self.weights
                grad_sq += g * g
                self.weights += rate * g / np.sqrt(grad_sq)
                gold = np.zeros((k, k))
                for _, z in joined:
                    np.add.at(gold, (z[:-1], z[1:]), 1)
                gt = (gold - pairs) / len(y)
                tr_sq += gt * gt
                self.trans += 0.3 * rate * gt / np.sqrt(tr_sq)
                gs = -post[0].sum(axis=0)
                np.add.at(gs, [z[0] for _, z in joined], 1)
                gs /= len(y)
                st_sq += gs * gs
                self.first += 0.3 * rate * gs / np.sqrt(st_sq)


def mean_posteriors(emit: np.ndarray, length: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean posterior per label of padded sequences in order of falling length; ``emit`` holds exponentials. The
    sequences still running at a step are a prefix of the lanes, so steps work on slices."""
    steps, lanes, k = emit.shape
    m, start = np.exp(trans).astype(emit.dtype), np.exp(first).astype(emit.dtype)
    back = np.ascontiguousarray(m.T)
    alive = np.searchsorted(-length, -np.arange(steps), side="left")       # lanes with length > t
    cur = start * emit[0]
    fwd = np.empty_like(emit)
    for t in range(steps):
        n = alive[t]
        if t:
            cur = (cur[:n] @ m) * emit[t, :n]
        cur = cur / cur.sum(axis=1, keepdims=True)
        fwd[t, :n] = cur
    total = np.zeros((lanes, k))
    b = np.ones((lanes, k), emit.dtype)
    for t in range(steps - 1, -1, -1):
        n = alive[t]
        post = fwd[t, :n] * b[:n]
        total[:n] += post / post.sum(axis=1, keepdims=True)
        if t:
            nxt = (emit[t, :n] * b[:n]) @ back
            b[:n] = nxt / nxt.sum(axis=1, keepdims=True)
    return total / length[:, None]


class Labeller:
    """Applies a model to texts; holds the emissions of about ``cap`` distinct words."""

    def __init__(self, model: Crf, cap: int = 400_000):
        self.model, self.cap = model, cap
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.table = np.empty((1 << 12, len(self.model.labels)), np.float32)

    def _numbers(self, words: list[list[bytes]]) -> list[np.ndarray]:
        new = list({w for d in words for w in d}.difference(self.index))
        if new:
            at = len(self.index)
            self.index.update(zip(new, range(at, at + len(new))))
            if len(self.index) > len(self.table):
                grown = np.empty((2 * len(self.index), self.table.shape[1]), np.float32)
                grown[:at] = self.table[:at]
                self.table = grown
            e = self.model.emissions(new)
            self.table[at:at + len(new)] = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -30))
        get = self.index.__getitem__
        return [np.fromiter(map(get, d), np.int32, len(d)) for d in words]

    def posteriors(self, words: list[str]) -> np.ndarray:
        """(word, label) posteriors of one sequence of words."""
        emit = self.model.emissions([w.lower().encode() for w in words])[:, None, :]
        return forward_backward(emit, np.array([len(words)]), self.model.trans, self.model.first)[0][:, 0]

    def documents(self, texts: list[str], cells: int = 400_000, at_once: int = 2_000_000) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not self.model.labels:
            return out
        held: list[tuple[int, np.ndarray]] = []
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= at_once):
                size += len(texts[j])
                j += 1
            if len(self.index) > self.cap:
                self._run(held, out, cells)
                held = []
                self._forget()
            held += [(i + k, ids) for k, ids in enumerate(self._numbers([words_of(t) for t in texts[i:j]])) if len(ids)]
            i = j
        self._run(held, out, cells)
        return out

    def _run(self, held: list[tuple[int, np.ndarray]], out: list, cells: int) -> None:
        """Forward-backward over documents of like length, about ``cells`` words at a time."""
        held = sorted(held, key=lambda x: len(x[1]))
        while held:
            longest = len(held[-1][1])
            lanes = [held.pop()]
            while held and (len(lanes) + 1) * longest <= cells and (2 * len(held[-1][1]) >= longest or longest < 64):
                lanes.append(held.pop())
            length = np.array([len(x) for _, x in lanes])
            emit = np.ones((longest, len(lanes), self.table.shape[1]), np.float32)
            lane = np.repeat(np.arange(len(lanes)), length)
            time = np.arange(len(lane)) - np.repeat(np.cumsum(length) - length, length)
            emit[time, lane] = self.table[np.concatenate([x for _, x in lanes])]
            mean = mean_posteriors(emit, length, self.model.trans, self.model.first)
            for (i, _), row in zip(lanes, mean):
                best = int(np.argmax(row))
                out[i] = (self.model.labels[best], float(min(1.0, max(0.0, row[best]))))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(df: DataFrame, labelled: Column, sample_rows: int = 4000, per_row: int = 3, segment: int = 32,
        rounds: int = 3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Crf:
    """Fit a model. About ``sample_rows`` labelled rows (at most twice as many) are chosen by a hash of the row, and
    from each up to ``per_row`` segments of ``segment`` words at places spread over the whole text: that bounds
    what the driver holds. The lexicon lists the words that the sample shows at least three times in a language, in
    that language more than four times as often as chance."""
    rows = (df.where(labelled & col(lang_col).isNotNull() & col(text_col).isNotNull())
            .select(col(text_col).cast("string").alias("t"), col(lang_col).cast("string").alias("y"),
                    F.xxhash64(col(id_col).cast("string"), col(text_col)).alias("h")))
    share = min(1.0, sample_rows / max(1, rows.count()))
    chosen = rows.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).drop("h").limit(2 * sample_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, langs = [], []
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(t)
                most = min(per_row, -(-len(w) // segment))
                for i in range(most):
                    at = (len(w) * (2 * i + 1) // (2 * most)) - segment // 2 if most > 1 else 0
                    at = max(0, min(at, len(w) - segment))
                    words.append(w[at:at + segment])
                    langs.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.binary())), pa.array(langs, pa.string())],
                                             ["w", "y"])

    got = [([bytes(x) for x in r["w"]], r["y"]) for r in chosen.mapInArrow(cut, "w array<binary>, y string").toLocalIterator()]
    got = sorted((w, y) for w, y in got if w)
    labels = sorted({y for _, y in got})
    number = {y: i for i, y in enumerate(labels)}
    seen = [Counter() for _ in labels]
    for w, y in got:
        seen[number[y]].update(w)
    sums = np.array([max(1, sum(c.values())) for c in seen], float)
    lexicon: dict[bytes, list[int]] = {}
    for i, c in enumerate(seen):
        for w, n in c.items():
            rest = sum(o[w] for j, o in enumerate(seen) if j != i) / max(1.0, sums.sum() - sums[i])
            if n >= 3 and n / sums[i] > 4 * rest:
                lexicon.setdefault(w, []).append(i)
    model = Crf(labels, lexicon)
    if len(labels) > 1:
        model.train([(w, number[y]) for w, y in got], rounds=rounds, batch=128, rate=0.5, l2=1e-6)
    return model


def has_letter(text: str) -> bool:
    """Whether ``words_of`` finds any word."""
    return any(map(str.isalpha, text))


def label(df: DataFrame, model: Crf, text_col: str = "text", lang_out: str = "lang_pred",
          score_out: str = "score", letter_out: str | None = None) -> DataFrame:
    """``df`` with the predicted language and its score appended, and with ``letter_out`` whether the text has a letter,
    which does not depend on the model (their names must be free)."""
    names = [lang_out, score_out] + ([letter_out] if letter_out else [])
    for name in names:
        if name.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"column {name} exists already")
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kinds = [T.StringType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*df.schema.fields, *map(T.StructField, names, kinds)])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lab = Labeller(shared.value)
        for b in batches:
            texts = [t or "" for t in b.column(at).cast(pa.string()).to_pylist()]
            got = lab.documents(texts)
            new = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            if letter_out:
                new.append(pa.array([has_letter(t) for t in texts], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, *names])

    return df.mapInArrow(run, schema)


def language_query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    model = fit(docs, ~held_out())
    found = label(docs.select(col("doc_id").alias("doc_id"), held_out().alias("held_out"),
                              text_or_empty("text").alias("text")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
