"""Sequence tagger (M2): a linear-chain conditional random field over hashed context features.

Training goes in epochs.  The records lie in shards of bounded size; in an epoch each shard
starts from the common weights, makes one pass of gradient steps over its records (each weight's
step shrinks with the squares of its own gradients so far) and gives back what its weights and
sums of squares changed, and the changes are averaged over the shards (weighed by their records) by one aggregate.  After every epoch the validation records are tagged and scored; training stops
when the F1 has not grown for ``patience`` epochs, and the best epoch's weights are kept.  A record
is scored by forward-backward sums, so that a loss (mean negative log likelihood of a token)
and a probability of each tag come with it; tags are the best path (Viterbi), on which an ``I-``
tag only follows its own type.

The model is a table of at most ``buckets`` feature rows with a weight a label, a start row and a
transition matrix: the size of what is broadcast and collected has that bound, whatever the
corpus is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashed import context_features, xxhash64
from ..session import local_table, materialize
from ..sources.dictionary import LABELS
from .evaluation import best_run, evaluate
from .training import METRICS, feature_rows, token_rows, token_schema

BUCKETS = 1 << 18
SHARD_RECORDS = 20_000
BATCH = 16
TOGETHER = 1 << 14  # places (padded) of the records tagged at once
FORBIDDEN = -1e4
FIRST_SQUARE = 1e-8
LEAST = 600.0  # in logarithms; doubles end at about -708


def bio_rules(labels: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Start and transition scores: 0, or ``FORBIDDEN`` where ``I-x`` follows neither ``B-x`` nor ``I-x``."""
    inside = [t[2:] if t.startswith("I-") else None for t in labels]
    start = np.array([FORBIDDEN if t else 0.0 for t in inside])
    move = np.array([[FORBIDDEN if t and (p[2:] != t or p[1:2] != "-") else 0.0 for t in inside] for p in labels])
    return start, move


def viterbi(scores: np.ndarray, start: np.ndarray, move: np.ndarray) -> list[int]:
    """The best path over ``scores`` (positions x labels); the lowest label wins ties, from the end."""
    if not len(scores):
        return []
    best, back = start + scores[0], []
    for s in scores[1:]:
        total = best[:, None] + move
        back.append(total.argmax(0))
        best = total.max(0) + s
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _by_size(scores: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, scores, left)`` of a batch: its records by falling size, as positions x labels x records, and how
    many records have each position (a last 0), so that a step reads the first records only."""
    order = np.argsort(-size, kind="stable")
    left = np.searchsorted(-size[order], -np.arange(scores.shape[1] + 1))
    return order, np.ascontiguousarray(scores[order].transpose(1, 2, 0)), left


def viterbi_paths(scores: np.ndarray, size: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """``viterbi`` of a batch (records x positions x labels, ``size`` >= 1 positions each); past the end 0.

    The way forward keeps the best sums only; the way back finds each tag from those of the position before."""
    n, longest, _k = scores.shape
    order, s, left = _by_size(scores, size)
    best = np.empty_like(s)
    best[0] = start[:, None] + s[0]
    for t in range(1, longest):
        m = left[t]
        np.add((best[t - 1][:, None, :m] + move[:, :, None]).max(0), s[t][:, :m], out=best[t][:, :m])
    path, now = np.zeros((n, longest), np.int32), np.zeros(n, np.int64)
    for t in range(longest - 1, -1, -1):
        on, m = left[t + 1], left[t]
        now[:on] = (best[t][:, :on] + move[:, now[:on]]).argmax(0)
        now[on:m] = best[t][:, on:m].argmax(0)
        path[order[:m], t] = now[:m]
    return path


PATHS_AT_ONCE = 256


def _path_arrays(rows: pa.Array, start: np.ndarray, move: np.ndarray) -> pa.Array:
    """Best paths of an Arrow batch, ``PATHS_AT_ONCE`` records of about equal length at a time.  A null record has none."""
    bounds = rows.offsets.to_numpy().astype(np.int64) - rows.offsets[0].as_py()
    flat = rows.flatten()  # positions; null records hold none
    size = np.where(np.asarray(rows.is_null()), 0, np.diff(bounds))
    values = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), float).reshape(len(flat), len(start))
    first, paths = np.cumsum(size) - size, np.zeros(len(flat), np.int32)
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0]
    for k in range(0, len(order), PATHS_AT_ONCE):
        some = order[k:k + PATHS_AT_ONCE]
        n = size[some]
        inside = np.arange(n[-1]) < n[:, None]
        at = (first[some][:, None] + np.arange(n[-1]))[inside]
        scores = np.zeros((*inside.shape, len(start)))
        scores[inside] = values[at]
        paths[at] = viterbi_paths(scores, n, start, move)[inside]
    cut = pa.array(np.append(first, len(flat)), pa.int32(), mask=np.append(np.asarray(rows.is_null()), False))
    return pa.ListArray.from_arrays(cut, pa.array(paths))


def viterbi_path(scores: Column, start: np.ndarray, move: np.ndarray) -> Column:
    """Best paths of ``array<array<double>>`` (positions x labels) as ``array<int>``, in-row."""
    return F.arrow_udf(lambda rows: _path_arrays(rows, start, move), "array<int>")(scores)


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def forward_backward(scores: np.ndarray, size: np.ndarray, start: np.ndarray, move: np.ndarray, with_moves: bool = True):
    """``(log sum of all paths, tag probabilities, expected moves)`` of a batch (records x positions x
    labels, ``size`` positions each); no moves are added up unless ``with_moves``.

    The sums are products of matrices, brought to a sum of 1 at each position, where the scores are
    so near each other that none gets lost; else they are sums in logarithms."""
    found = _product_sums(scores, size, start, move, with_moves)
    return found or _log_sums(scores, size, start, move, with_moves)


def _near(apart: float, start: np.ndarray, move: np.ndarray) -> bool:
    """Whether no sum falls below ``exp(-LEAST)`` of its position's largest: each label is reached from each
    by few allowed moves, and the moves and the scores of a position (``apart``) are of such a range."""
    allowed, steps = move > FORBIDDEN / 2, 1
    ways = allowed
    while not ways.all() and steps < len(start):
        ways, steps = ways @ allowed, steps + 1
    first = start[start > FORBIDDEN / 2]
    return bool(ways.all() and len(first) and (steps + 1) * (apart + np.ptp(move[allowed])) + np.ptp(first) < LEAST)


def _product_sums(scores, size, start, move, with_moves):
    n, longest, k = scores.shape
    order, s, left = _by_size(scores, size)
    inside = np.arange(longest)[:, None] < size[order]
    top = s.max(1)
    if not _near(((top - s.min(1)) * inside).max(), start, move):
        return None
    first, most = start.max(), move.max()
    e, over = np.exp(s - top[:, None]), np.exp(move - most)
    back = np.ascontiguousarray(over.T)
    ahead, after, part = np.empty((longest, k, n)), np.ones((longest, k, n)), np.empty((longest, n))
    e[0] *= np.exp(start - first)[:, None]
    ahead[0] = e[0]
    for t, (a, x, c) in enumerate(zip(ahead, e, part)):
        if t:  # places past the end hold ones and are left out below
            np.matmul(back, ahead[t - 1], out=a)
            a *= x
        np.add.reduce(a, 0, out=c)
        a /= c
    e /= part[:, None]  # from here on each position's scores over its sum
    for t in range(longest - 1, 0, -1):
        m, x = left[t], e[t]
        x *= after[t]
        np.matmul(over, x, out=after[t - 1])
        if m < n:
            after[t - 1][:, m:] = 1
            x[:, m:] = 0
    whole = np.empty(n)
    whole[order] = (np.where(inside, np.log(part) + top, 0)).sum(0) + first + (size[order] - 1) * most
    if not np.isfinite(whole).all():
        return None
    moves = over * np.tensordot(ahead[:-1], e[1:], ((0, 2), (0, 2))) if with_moves else np.zeros((k, k))
    tags = np.empty((n, longest, k))
    tags[order] = (ahead * after * inside[:, None]).transpose(2, 0, 1)
    return whole, tags, moves


def _log_sums(scores, size, start, move, with_moves):
    n, longest, k = scores.shape
    ahead, after = np.zeros((longest, n, k)), np.zeros((longest, n, k))
    ahead[0] = start + scores[:, 0]
    for t in range(1, longest):
        step = _total(ahead[t - 1][:, :, None] + move, 1) + scores[:, t]
        ahead[t] = np.where((t < size)[:, None], step, ahead[t - 1])
    whole = _total(ahead[-1], 1)
    moves = np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        here = (t < size)[:, None]
        into = (scores[:, t] + after[t])[:, None, :] + move
        if with_moves:
            moves += np.exp(np.where(here[:, :, None], ahead[t - 1][:, :, None] + into - whole[:, None, None], -np.inf)).sum(0)
        after[t - 1] = np.where(here, _total(into, 2), 0.0)
    tags = np.exp(ahead + after - whole[None, :, None]).transpose(1, 0, 2)
    return whole, tags * (np.arange(longest) < size[:, None])[:, :, None], moves


def _bounds(lists: pa.Array) -> np.ndarray:
    """Where the lists of an array begin and end in ``lists.flatten()``; null lists hold nothing."""
    size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    return np.concatenate(([0], np.cumsum(np.where(np.asarray(lists.is_valid()), size, 0))))


class SequenceModel:
    """Weights by feature number (sorted), start and transition scores, label names."""

    def __init__(self, labels: Sequence[str], buckets: int = BUCKETS, features=None, weights=None, start=None, move=None, squares=None):
        k = len(labels)
        self.labels, self.buckets = list(labels), buckets
        self.features = np.zeros(0, np.int64) if features is None else features
        self.weights = np.zeros((0, k)) if weights is None else weights
        self.start = np.zeros(k) if start is None else start
        self.move = np.zeros((k, k)) if move is None else move
        # sums of squared gradients, in training only: of the weights, then of start and moves
        self.squares = np.zeros((len(self.features) + 1 + k, k)) if squares is None else squares
        self.rules = bio_rules(self.labels)

    def parameters(self) -> np.ndarray:
        """Weights, start and moves as one table; its rows are numbered by ``parameter_names``."""
        return np.vstack([self.weights, self.start, self.move])

    def parameter_names(self) -> np.ndarray:
        """Feature numbers, then -1 for the start and -2, -3, ... for the moves from each label."""
        return np.r_[self.features, -1 - np.arange(len(self.labels) + 1)]

    def rows_of(self, ids: np.ndarray) -> np.ndarray:
        """Weight row of each feature; the last row (of zeros) for unknown ones."""
        at = np.minimum(np.searchsorted(self.features, ids), max(len(self.features) - 1, 0))
        return np.where(self.features[at] == ids, at, len(self.features)) if len(self.features) else np.zeros(len(ids), np.int64)

    def scores(self, feats: list[list[int]]) -> np.ndarray:
        if not feats:
            return np.zeros((0, len(self.labels)))
        table = np.vstack([self.weights, np.zeros(len(self.labels))])
        size = np.array([len(f) for f in feats])
        flat = table[self.rows_of(np.array([x for f in feats for x in f], np.int64))]
        out = np.zeros((len(feats), len(self.labels)))
        np.add.at(out, np.repeat(np.arange(len(feats)), size), flat)
        return out

    def tag(self, feats: list[list[int]]) -> tuple[list[int], list[float], np.ndarray]:
        """``(tags, their probabilities, scores)`` of one record."""
        s = self.scores(feats)
        if not len(s):
            return [], [], s
        path, sure, _sums = self.tag_places(s, np.array([0, len(s)]))
        return path.tolist(), sure.tolist(), s

    def tag_places(self, scores: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(tags, their probabilities, log sum of all paths by record)`` of the scores of many records, with
        the bounds ``cut``.  Records of similar length are tagged together, at most ``TOGETHER`` places at once."""
        start, move = self.start + self.rules[0], self.move + self.rules[1]
        size = np.diff(cut)
        tags, sure, sums = np.zeros(len(scores), np.int32), np.zeros(len(scores)), np.zeros(len(size))
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        while len(order):
            n = max(1, min(len(order), TOGETHER // int(size[order[-1]])))
            some, order = order[-n:], order[:-n]
            inside = np.arange(size[some[-1]]) < size[some][:, None]
            at = (cut[some][:, None] + np.arange(inside.shape[1]))[inside]
            padded = np.zeros((*inside.shape, len(self.labels)))
            padded[inside] = scores[at]
            paths = viterbi_paths(padded, size[some], start, move)
            sums[some], p, _m = forward_backward(padded, size[some], start, move, with_moves=False)
            tags[at] = paths[inside]
            sure[at] = np.minimum(1.0, np.take_along_axis(p, paths[:, :, None].astype(np.int64), 2)[:, :, 0][inside])
        return tags, sure, sums

    def tag_batch(self, feats: pa.Array):
        """``(tags, probabilities, scores, log sum)`` by record of a ``list<list<int64>>`` array; None for empty records."""
        inner, cut = feats.flatten(), _bounds(feats)
        ids, at = inner.flatten().to_numpy(zero_copy_only=False), _bounds(inner)
        width = np.diff(at)
        scores = np.zeros((len(inner), len(self.labels)))
        row = self.rows_of(ids)
        table = np.vstack([self.weights, np.zeros(len(self.labels))])
        if len(width) and width[0] and (width == width[0]).all():
            for j in range(width[0]):  # in the order of the features
                scores += table[row[j::width[0]]]
        else:
            np.add.at(scores, np.repeat(np.arange(len(inner)), width), table[row])
        tags, sure, sums = self.tag_places(scores, cut)
        return [(tags[a:b], sure[a:b], scores[a:b], w) if a < b else None for a, b, w in zip(cut[:-1], cut[1:], sums)]

    def place_scores(self, features: list[tuple[pa.Array, np.ndarray]]) -> np.ndarray:
        """Scores of places with the features of ``context_features``; each different feature is looked up once."""
        scores = np.zeros((len(features[0][1]), len(self.labels)))
        for names, at in features:
            row = self.rows_of(xxhash64(names) % self.buckets)
            known = row < len(self.features)
            if known.any():
                has = np.flatnonzero(known[at])
                scores[has] += self.weights[row[at[has]]]
        return scores

    def loss(self, s: np.ndarray, gold: Sequence[int], whole: float | None = None) -> float:
        start, move = self.start + self.rules[0], self.move + self.rules[1]
        if whole is None:
            whole = forward_backward(s[None], np.array([len(s)]), start, move)[0][0]
        gold = np.asarray(gold)
        own = start[gold[0]] + s[np.arange(len(s)), gold].sum() + move[gold[:-1], gold[1:]].sum()
        return float(whole - own)


def _feature_numbers(tokens: pa.Array, buckets: int) -> pa.Array:
    """``feats`` of the records of an Arrow batch; a null record has none."""
    cut = _bounds(tokens)
    features = context_features(pc.fill_null(tokens.flatten().cast(pa.string()), ""), cut)
    numbers = np.stack([(xxhash64(names) % buckets)[at] for names, at in features], 1)
    each = pa.ListArray.from_arrays(pa.array(np.arange(len(numbers) + 1) * len(features), pa.int32()), pa.array(numbers.ravel()))
    missing = np.append(np.asarray(tokens.is_null()), False)
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32(), mask=missing), each)


def sequence_rows(records: DataFrame, buckets: int = BUCKETS, id_col: str = "id") -> DataFrame:
    """``(id, feats array<array<bigint>>, gold array<int>)``: numbers of the context features of each token.  Only
    records with a null token go through the SQL features."""
    def run(tokens: pa.Array) -> pa.Array:
        return _feature_numbers(tokens, buckets)

    slow = F.transform(feature_rows(), lambda f: F.transform(f["features"], lambda x: F.pmod(F.xxhash64(x), F.lit(buckets))))
    feats = F.when(F.exists("tokens", lambda t: t.isNull()), slow).otherwise(F.arrow_udf(run, "array<array<bigint>>")(F.col("tokens")))
    return records.select(F.col(id_col).cast("string").alias("id"), feats.alias("feats"), F.col("ner_tags").cast("array<int>").alias("gold"))


def _summed(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows of ``values`` by ``at`` (below ``n``), added in their order."""
    k = values.shape[1]
    return np.bincount((at[:, None] * k + np.arange(k)).ravel(), values.ravel(), n * k).reshape(n, k)


def _shard_pass(shared, rate: float):
    def run(group: pa.Table) -> pa.Table:
        model: SequenceModel = shared.value
        k = len(model.labels)
        rows = group.select(["id", "feats", "gold"])
        rows = rows.filter(pc.greater(pc.list_value_length(rows["gold"]), 0))
        rows = rows.take(pc.sort_indices(rows, [("id", "ascending")])).combine_chunks()
        feats, golds = (pa.concat_arrays([pa.array([], rows.schema.field(c).type), *rows[c].chunks]) for c in ("feats", "gold"))
        inner, cut = feats.flatten(), _bounds(golds)
        begin, labels = _bounds(inner), golds.flatten().to_numpy(zero_copy_only=False)
        coded = inner.flatten().dictionary_encode()
        order = np.argsort(coded.dictionary.to_numpy())
        ids, place_of = coded.dictionary.to_numpy()[order], np.argsort(order)[coded.indices.to_numpy()]
        n, known = len(ids), model.rows_of(ids)
        own = np.r_[known, len(model.features) + 1 + np.arange(k + 1)]  # the row before start is of zeros
        spaced = lambda x: np.insert(x, len(model.features), 0.0, axis=0)[own]
        w, squares = spaced(model.parameters()), spaced(model.squares)
        before = w.copy(), squares.copy()

        last = np.zeros(n, np.int64)

        def climb(at, slope):
            squares[at] = sums = squares[at] + slope**2
            w[at] += rate * slope / np.sqrt(sums + FIRST_SQUARE)

        for lo in range(0, len(rows), BATCH):
            ends = cut[lo:lo + BATCH + 1]
            size, gold = np.diff(ends), labels[ends[0]:ends[-1]]
            count, at = np.diff(begin[ends[0]:ends[-1] + 1]), place_of[begin[ends[0]]:begin[ends[-1]]]
            last[at] = each = np.arange(len(at))
            used = at[last[at] == each]  # each feature at the last place that has it
            last[used] = np.arange(len(used))
            place = last[at]
            inside = np.arange(size.max()) < size[:, None]
            scores = np.zeros((*inside.shape, k))
            scores[inside] = _summed(np.repeat(np.arange(len(gold)), count), w[used][place], len(gold))
            _whole, tags, moves = forward_backward(scores, size, w[n] + model.rules[0], w[n + 1:] + model.rules[1])
            step = -tags[inside]
            step[np.arange(len(gold)), gold] += 1
            climb(used, _summed(place, np.repeat(step, count, axis=0), len(used)))
            first = np.zeros(len(gold), bool)
            first[ends[:-1] - ends[0]] = True
            climb(slice(n, n + 1), step[first].sum(0)[None])
            seen = np.bincount((gold[:-1] * k + gold[1:])[~first[1:]], minlength=k * k).reshape(k, k)
            climb(slice(n + 1, None), seen - moves)
        names = np.r_[ids, -1 - np.arange(k + 1)]
        change, growth = w - before[0], squares - before[1]
        some = growth.any(1)
        values = len(rows) * np.hstack([change[some], growth[some]])
        return pa.table([pa.array(names[some], pa.int64()), *(pa.array(x) for x in values.T)], ["feature", *_sums(k)])
    return run


def _sums(k: int) -> list[str]:
    """Names of the columns of a row's changes, then of the growth of its squares, one a label."""
    return [f"{c}{j}" for c in ("change", "growth") for j in range(k)]


def _epoch(rows: DataFrame, model: SequenceModel, n: int, rate: float) -> SequenceModel:
    """The model after one pass of all shards and the average of their changes; a shard gives one row a feature."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    k = len(model.labels)
    change = rows.groupBy("shard").applyInArrow(_shard_pass(shared, rate), "feature long, " + ", ".join(f"{c} double" for c in _sums(k)))
    got = change.groupBy("feature").agg(*[(F.sum(c) / n).alias(c) for c in _sums(k)]).toArrow()
    shared.unpersist()
    feature = got.column("feature").to_numpy()
    features = np.unique(np.r_[model.features, feature[feature >= 0]])
    out = SequenceModel(model.labels, model.buckets, features, np.zeros((len(features), k)))
    names = out.parameter_names()
    order = np.argsort(names)
    row = lambda x: order[np.searchsorted(names, x, sorter=order)]
    tables = []
    for old, new in ((model.parameters(), _sums(k)[:k]), (model.squares, _sums(k)[k:])):
        x = np.zeros((len(names), k))
        x[row(model.parameter_names())] = old
        x[row(feature)] += np.stack([got.column(c).to_numpy() for c in new], 1)
        tables.append(x)
    f = len(features)
    return SequenceModel(model.labels, model.buckets, features, tables[0][:f], tables[0][f], tables[0][f + 1:], tables[1])


def _tag_lists(found: list, more: dict[str, pa.Array], name: str) -> pa.Array:
    """The tags and probabilities of ``tag_batch`` as a list of structs by record, with ``more`` flat columns."""
    flat = lambda i, t: np.concatenate([np.zeros(0, t), *(x[i] for x in found if x)]).astype(t)
    cols = {name: pa.array(flat(0, np.int32)), "confidence": pa.array(flat(1, np.float64)), **more}
    cut = np.cumsum([0, *(len(x[0]) if x else 0 for x in found)])
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(list(cols.values()), list(cols)))


def predict_sequence(rows: DataFrame, model: SequenceModel) -> DataFrame:
    """``(id, pos, gold, pred, confidence, loss)`` of ``sequence_rows``: the best path, the probability of
    each tag and the record's loss a token (null without gold tags)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(feats: pa.Array, gold: pa.Array) -> pa.Array:
        m, costs = shared.value, []
        found = m.tag_batch(feats)
        for x, g in zip(found, gold.to_pylist()):
            known = x and g and len(g) == len(x[0]) and all(t is not None for t in g)
            costs.append(m.loss(x[2], g, x[3]) / len(g) if known else None)
        size = [len(x[0]) if x else 0 for x in found]
        cost = np.repeat(np.array([np.nan if c is None else c for c in costs], float), size)
        unknown = np.repeat(np.array([c is None for c in costs], bool), size)
        return _tag_lists(found, {"loss": pa.array(cost, pa.float64(), mask=unknown)}, "pred")

    tagged = F.arrow_udf(run, "array<struct<pred:int,confidence:double,loss:double>>")(F.col("feats"), F.col("gold"))
    out = rows.withColumn("_t", tagged).select("id", "gold", F.posexplode("_t").alias("pos", "t"))
    return out.select("id", "pos", F.get("gold", F.col("pos")).alias("gold"), "t.pred", "t.confidence", "t.loss")


def train_sequence_tagger(train: DataFrame, valid: DataFrame, epochs: int = 10, patience: int = 2, rate: float = 0.3,
                          buckets: int = BUCKETS, labels: Sequence[str] | None = None) -> tuple[SequenceModel, DataFrame]:
    """Fit on ``train`` records (``id, tokens, ner_tags``); the best epoch's model by F1 on ``valid`` (ties
    to the earlier) and one metrics row an epoch (``epoch``, ``METRICS``, ``loss``)."""
    labels = labels or [t for _i, t in LABELS]
    rows = materialize(sequence_rows(train, buckets), "sequence-train")
    n = rows.count()
    shards = max(1, -(-n // SHARD_RECORDS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    held = materialize(sequence_rows(valid, buckets), "sequence-valid")
    model = SequenceModel(labels, buckets)
    best, records = (model, -1.0, -1), []
    for e in range(epochs if n else 0):
        model = _epoch(rows, model, n, rate)
        pred = materialize(predict_sequence(held, model), "sequence-pred")
        r = evaluate(pred.select("id", "pos", "gold", "pred")).first()
        loss = pred.agg(F.avg("loss")).first()[0]
        records.append(("epochs", float(e), *[float(r[m]) if r[m] is not None else None for m in METRICS], loss))
        if (r.f1 or 0.0) > best[1]:
            best = (model, r.f1 or 0.0, e)
        elif e - best[2] >= patience:
            break
    metrics = local_table(train.sparkSession, records, "run string, epoch double, " + ", ".join(f"{m} double" for m in METRICS) + ", loss double")
    if records:
        chosen = best_run(metrics, "run", "f1", "epoch").first()
        assert chosen is None or int(chosen.epoch) == best[2]
    return best[0], metrics


def save_sequence_tagger(model: SequenceModel, path: str, spark: SparkSession, metrics: DataFrame | None = None) -> None:
    """Weights, label names and metrics as tables below ``path``."""
    base = path.rstrip("/")
    rows = [(int(f), w.tolist()) for f, w in zip(model.features, model.weights)]
    rows += [(-1, model.start.tolist())] + [(-2 - i, w.tolist()) for i, w in enumerate(model.move)]
    local_table(spark, rows, "feature long, weights array<double>").write.mode("overwrite").parquet(f"{base}/weights")
    local_table(spark, [(i, t, model.buckets) for i, t in enumerate(model.labels)], "id int, tag string, buckets long").write.mode("overwrite").parquet(f"{base}/labels")
    if metrics is not None:
        metrics.write.mode("overwrite").json(f"{base}/metrics")


def load_sequence_tagger(spark: SparkSession, path: str) -> SequenceModel:
    base = path.rstrip("/")
    names = spark.read.parquet(f"{base}/labels").orderBy("id").collect()
    rows = {r.feature: r.weights for r in spark.read.parquet(f"{base}/weights").collect()}
    ids = np.array(sorted(f for f in rows if f >= 0), np.int64)
    weights = np.array([rows[f] for f in ids.tolist()]).reshape(len(ids), len(names))
    return SequenceModel([r.tag for r in names], names[0].buckets, ids, weights, np.array(rows[-1]), np.array([rows[-2 - i] for i in range(len(names))]))


def tag_sequences(chunks: DataFrame, model: SequenceModel, keep: Sequence[str] = ("doc_id", "chunk_no")) -> DataFrame:
    """M1: words of each chunk with offsets, tag name and its probability: ``(keep, pos, word, start,
    end, tag, confidence)``.  Row-local: a batch of texts becomes the rows of its words in one pass."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for rows, cut, cols, tokens in token_rows(batch, keep):
                tags, sure, _sums = m.tag_places(m.place_scores(context_features(tokens, cut)), cut)
                names = pa.array(m.labels, pa.string()).take(pa.array(tags))
                yield pa.RecordBatch.from_arrays([*cols, names, pa.array(sure)], [*rows, "tag", "confidence"])

    return chunks.select(*keep, "text").mapInArrow(run, token_schema(chunks, keep).add("tag", "string").add("confidence", "double"))
