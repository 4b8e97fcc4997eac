"""Quality classifier (operator 3): co-training of two views.

A *view* turns a document into a set of 32-bit features:

* content: its lower-case terms, its runs of signs, how often a term follows
  itself, and layout figures (lines, line and word lengths, shares of capitals,
  digits, signs and blanks) on fixed grids: all that the text says,
* metadata: what stands beside the text: language, source, the two together, and
  the given length (``n_chars``, where the table has it). It never reads the text.

For each target (low quality, toxic) both views learn a logistic regression on
features that the chi-square test selects. In each round each view scores *all*
documents outside the labelled sample, labels those that it is surest of, and the
*other* view learns from them too. Afterwards each view's score is calibrated on
labelled documents kept aside, a last regression combines the two calibrated
scores, and every document of the table is scored and judged.

Bounds: what is fitted on are ``max_labelled`` labelled documents (those with the
least hash of the id among the documents that have a label, so neither other
documents' labels nor the layout of the files matter) and, in each round, ``pseudo``
of each class and view. Their feature sets, not their texts, come to the driver;
what tasks get is the selected features' weights and the ids that are used already.
Feature sets of all documents are written once and read by every round.

Edge cases: a null text, language or source is an empty one; label rows with
null ids are not used, and if an id has several labels the worst of each target
counts; of rows that share an id the one with the least features is learned from;
if a target's labels of these documents lack one of the two classes, the target
rejects nothing (score 0); null or repeated ids are scored row by row; an empty table
gives no rows. Columns to carry (``keep``) may have any name that the result has not.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.anchors import word_symbols
from starloom.llm.common import carried, map_arrow, materialize, texts, unpacked

MAX_LABELLED = 16000
ROUNDS = 3
#: Surest documents that a view labels in a round, of each class.
PSEUDO = 400
#: A pseudo-label needs this probability at least.
SURE = 0.95
CHI_SQUARE = 12.0
LEAST_COUNT = 4
MAX_FEATURES = 20_000
HELD_OUT = 0.3
TARGETS = ("low_quality", "toxic")

_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_SIGNS = ~np.array([i < 128 and i > 32 and not chr(i).isalnum() and i != 127 for i in range(256)])


def _feature(name: str) -> int:
    return zlib.crc32(name.encode())


_FOLLOWS = [_feature(f"follows {i}") for i in range(12)]
_SIGN_SHARE = [_feature(f"signs {i}") for i in range(12)]


def _grid(share: float, top: int = 11) -> int:
    """A share's place on a grid that is fine near 0."""
    return min(top, int(math.sqrt(share) * top + 1e-9)) if share > 0 else 0


_KIND = np.zeros(256, np.int64)  # 1 capital, 2 digit, 3 other sign, 4 white space
for _i in range(128):
    _KIND[_i] = 1 if chr(_i).isupper() else 2 if chr(_i).isdigit() else 4 if chr(_i).isspace() else 0 if chr(_i).isalpha() else 3


def _layout(data: bytes) -> list[int]:
    n = max(1, len(data))
    lines = data.split(b"\n")
    words = data.split()
    capital, digit, sign, space = (np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=5)[1:] / n).tolist()
    grids = {
        "length": round(2 * math.log2(n)), "lines": round(2 * math.log2(len(lines))), "line": round(2 * math.log2(n / len(lines))),
        "word": min(40, round(2 * n / max(1, len(words)))), "capital": round(50 * capital), "digit": round(50 * digit), "sign": round(50 * sign),
        "space": round(50 * space), "equal lines": _grid(1 - len(set(lines)) / len(lines)), "equal words": round(10 * len(set(words)) / max(1, len(words))),
    }
    return [_feature(f"{k} {v}") for k, v in grids.items()]


def content_view(data: bytes) -> np.ndarray:
    """Sorted features of a text."""
    terms = word_symbols(data.lower(), _ALNUM)
    signs = word_symbols(data, _SIGNS)
    follows = float((terms[1:] == terms[:-1]).mean()) if len(terms) > 1 else 0.0
    own = [_FOLLOWS[_grid(follows)], _SIGN_SHARE[_grid(min(1.0, len(signs) / max(1, len(terms))))], *_layout(data)]
    return np.unique(np.concatenate([(terms >> np.uint64(32)).astype(np.uint32), (signs >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995), np.array(own, np.uint32)]))


def metadata_view(lang: str, source: str, length: int | None) -> np.ndarray:
    """Sorted features of what stands beside a text."""
    own = [f"lang {lang}", f"source {source}", f"{lang} from {source}", f"given length {'none' if length is None else round(2 * math.log2(max(1, length)))}"]
    return np.unique(np.array([_feature(x) for x in own], np.uint32))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights (the last one is the constant) of a small dense regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Linear:
    """A sparse regression over features."""

    features: np.ndarray
    weights: np.ndarray
    constant: float

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """Of many feature sets at once."""
        sizes = np.array([len(s) for s in sets], np.int64)
        if not len(self.features) or not sizes.sum():
            return np.full(len(sets), self.constant)
        found = np.concatenate(sets)
        at = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
        hits = np.flatnonzero(self.features[at] == found)
        return self.constant + np.bincount(np.repeat(np.arange(len(sets)), sizes)[hits], self.weights[at[hits]], minlength=len(sets))


def fit_linear(sets: list[np.ndarray], y: np.ndarray, ridge: float = 1.0, steps: int = 120) -> Linear:
    """Select features by the chi-square test and learn their weights (Adam on
    the whole sample; the start is zero, so the result is always the same)."""
    names, cols = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    n, n1 = len(y), y.sum()
    a = np.bincount(cols, y[rows], minlength=len(names))
    both = np.bincount(cols, minlength=len(names))
    b, c = both - a, n1 - a
    d = n - n1 - b
    chi = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1)
    least = np.sort(chi)[-MAX_FEATURES] if len(chi) > MAX_FEATURES else 0.0
    keep = (chi >= max(CHI_SQUARE, least)) & (both >= LEAST_COUNT)
    number = np.cumsum(keep) - 1
    rows, cols = rows[keep[cols]], number[cols[keep[cols]]]
    k = int(keep.sum())
    w, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    w[k] = math.log((n1 + 1) / (n - n1 + 1))
    for t in range(1, steps + 1):
        error = sigmoid(np.bincount(rows, w[cols], minlength=n) + w[k]) - y
        g = np.append(np.bincount(cols, error[rows], minlength=k) + ridge * w[:k], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(names[keep], w[:k], float(w[k]))


@dataclass
class Judge:
    """Both views of a target, calibrated, and their combination."""

    views: list[Linear] = field(default_factory=list)
    scales: list[np.ndarray] = field(default_factory=list)
    combined: np.ndarray | None = None

    def calibrated(self, sets: list[list[np.ndarray]]) -> np.ndarray:
        """A column a view: its calibrated logit of each document."""
        return np.column_stack([c[0] * view.scores([x[v] for x in sets]) + c[1] for v, (view, c) in enumerate(zip(self.views, self.scales, strict=True))])

    def probabilities(self, sets: list[list[np.ndarray]]) -> np.ndarray:
        """Of the target, for documents' pairs of feature sets."""
        if self.combined is None or not sets:
            return np.zeros(len(sets))
        return sigmoid(np.clip(self.calibrated(sets), -12, 12) @ self.combined[:-1] + self.combined[-1])


def surest(judge: Judge, sets: list[list[np.ndarray]], order: np.ndarray, most: int) -> list[tuple[int, int, float, int]]:
    """(view, label, probability, place) of the documents that each view is surest of,
    ``most`` of each class; equal ones by ``order``."""
    out, logits = [], judge.calibrated(sets)
    for v in (0, 1):
        p = sigmoid(logits[:, v])
        for label, sure in ((1, p), (0, 1 - p)):
            at = np.flatnonzero(sure >= SURE)
            out += [(v, label, float(sure[i]), int(i)) for i in at[np.lexsort((order[at], -sure[at]))[:most]]]
    return out


def co_train(labelled: list[tuple[list[np.ndarray], int]], pool: list[list[np.ndarray]] | Callable, rounds: int = ROUNDS, most: int = PSEUDO) -> Judge:
    """Fit a target from (feature sets, label) rows and unlabelled documents:
    their feature sets, or a function ``(judge, used) -> [(view, label, id, sets)]``
    that finds those that a view is surest of and whose id is not used yet."""
    cut = max(1, round(len(labelled) * (1 - HELD_OUT)))
    train, held = labelled[:cut], labelled[cut:]
    if any(len({y for _, y in part}) < 2 for part in (train, held)):
        return Judge()

    def listed(judge: Judge, used: set) -> list[tuple]:
        left = [i for i in range(len(pool)) if i not in used]
        sets = [pool[i] for i in left]
        return [(v, label, left[i], sets[i]) for v, label, _, i in surest(judge, sets, np.arange(len(sets)), most)] if sets else []

    find = pool if callable(pool) else listed
    own = [[(sets[v], y) for sets, y in train] for v in (0, 1)]
    used: set = set()
    kept = [sets for sets, _ in held]
    y = np.array([y for _, y in held], float)
    for turn in range(rounds + 1):
        judge = Judge([fit_linear([s for s, _ in own[v]], np.array([t for _, t in own[v]], float)) for v in (0, 1)])
        judge.scales = [logistic(view.scores([s[v] for s in kept])[:, None], y, 1e-1) for v, view in enumerate(judge.views)]
        if turn == rounds:
            break
        for v, label, i, sets in find(judge, used):
            if i not in used:
                own[1 - v].append((sets[1 - v], label))
                used.add(i)
    judge.combined = logistic(np.clip(judge.calibrated(kept), -12, 12), y, 1e-1)
    return judge


def _views(text: str, lang: str, source: str, length: int | None) -> list[np.ndarray]:
    return [content_view(text.encode()), metadata_view(lang, source, length)]


VIEWS = ("content", "metadata")
BESIDE = ("lang", "source", "n_chars")


def _rows(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``texts`` with language, source and given length."""
    if clash := sorted({*keep} & {"doc_id", "kept", *(f"p_{t}" for t in TARGETS)}):
        raise ValueError(f"columns {clash} are in the result already")
    have = {c: c in df.columns for c in BESIDE}
    rows = texts(df, id_col, text_col, tuple(dict.fromkeys((*keep, *(c for c in BESIDE if have[c]))))) if keep or any(have.values()) else texts(df, id_col, text_col)
    word = {c: F.coalesce(F.col(f"_with.{c}").cast("string"), F.lit("")) if have[c] else F.lit("") for c in BESIDE[:2]}
    length = F.col("_with.n_chars").try_cast("long") if have["n_chars"] else F.lit(None).cast("long")
    rows = rows.select("doc_id", "text", word["lang"].alias("lang"), word["source"].alias("source"), length.alias("length"), *["_with"] * ("_with" in rows.columns))
    return rows.withColumn("_with", F.struct(*[F.col(f"_with.{c}") for c in keep])) if keep else rows.drop("_with")


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, content, metadata): both views of every row, as 32-bit features."""

    def run(batches):
        for batch in batches:
            sets = [_views(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source", "length")), strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {name: pa.array([s[v].tobytes() for s in sets], pa.binary()) for v, name in enumerate(VIEWS)})

    return map_arrow(_rows(df, id_col, text_col), run, "doc_id long, content binary, metadata binary")


def _sets(batch: pa.RecordBatch | pa.Table) -> list[list[np.ndarray]]:
    return [[np.frombuffer(x, np.uint32) for x in pair] for pair in zip(*(batch.column(v).to_pylist() for v in VIEWS), strict=True)]


def _sampled(found: DataFrame, labels: DataFrame, most: int) -> pa.Table:
    """(id, low_quality, toxic, content, metadata) of the ``most`` labelled
    documents whose ids have the least hashes, in that order."""
    worst = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg((1 - F.min("quality")).cast("int").alias("low_quality"), F.max("toxic").cast("int").alias("toxic"))
    ids = found.select("doc_id").filter("doc_id is not null").distinct()
    known = materialize(ids.join(worst, F.col("doc_id") == F.col("_id")).select("_id", *TARGETS, F.xxhash64("_id").alias("_h")), "labelled-documents")
    n = known.count()  # of documents with a label, whatever else is labelled
    if n > 3 * most:  # hashes are even, so far more than ``most`` lie below; the exact choice follows
        known = known.filter(F.col("_h") < -(2**63) + (3 * most * 2**64) // n)
    chosen = materialize(known.orderBy("_h", "_id").limit(most), "classifier-sample")
    # ``most`` ids, so it may be broadcast; rows that share an id are one before they are gathered
    sample = found.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("_id", *TARGETS, "_h").agg(F.min(F.struct(*VIEWS)).alias("v"))
    return sample.select("_id", *TARGETS, "v.*", "_h").orderBy("_h", "_id").toArrow()


def _finder(found: DataFrame, sampled: set, most: int) -> Callable:
    """What ``co_train`` asks in a round: a pass over the features of all documents
    outside the sample; each task brings the ids it is surest of, and the features
    of the surest of all are fetched."""

    def find(judge: Judge, used: set) -> list[tuple]:
        out_of = sampled | used

        def run(batches):
            best: dict[tuple, float] = {}
            for batch in batches:
                ids, sets = batch.column("doc_id").to_pylist(), _sets(batch)
                left = [i for i, x in enumerate(ids) if x is not None and x not in out_of]
                if not left:
                    continue
                order = np.array([ids[i] for i in left], np.int64)
                for v, label, sure, i in surest(judge, [sets[i] for i in left], order, most):
                    key = (v, label, int(order[i]))
                    best[key] = max(sure, best.get(key, 0.0))
                best = {k: s for part in ((v, y) for v in (0, 1) for y in (0, 1)) for k, s in sorted(((k, s) for k, s in best.items() if k[:2] == part), key=lambda x: (-x[1], x[0][2]))[:most]}
            if best:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in best], pa.int32()), pa.array([k[1] for k in best], pa.int32()), pa.array([k[2] for k in best], pa.int64()), pa.array([*best.values()], pa.float64())], ["view", "label", "doc_id", "sure"])

        tasks = map_arrow(found, run, "view int, label int, doc_id long, sure double").groupBy("view", "label", "doc_id").agg(F.max("sure").alias("sure"))
        tasks = materialize(tasks, "surest-documents")
        chosen = [(v, label, r.doc_id) for v in (0, 1) for label in (1, 0)
                  for r in tasks.filter((F.col("view") == v) & (F.col("label") == label)).orderBy(F.desc("sure"), "doc_id").limit(most).collect()]
        if not chosen:
            return []
        ids = found.sparkSession.createDataFrame([(i,) for i in sorted({i for *_, i in chosen})], "_id long")  # 4 * ``most`` at most
        top = found.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min(F.struct(*VIEWS)).alias("v")).select("doc_id", "v.*").toArrow()
        sets = dict(zip(top.column("doc_id").to_pylist(), _sets(top), strict=True))
        return [(v, label, i, sets[i]) for v, label, i in chosen]

    return find


def fit(df: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, pseudo: int = PSEUDO, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", found: DataFrame | None = None) -> dict[str, Judge]:
    """A judge for each target. ``found``: written ``features`` of ``df``."""
    found = materialize(features(df, id_col, text_col), "classifier-features") if found is None else found
    sample = _sampled(found, labels, max_labelled)
    sets, find = _sets(sample), _finder(found, {*sample.column("_id").to_pylist()}, pseudo)
    return {t: co_train([(s, y) for s, y in zip(sets, sample.column(t).to_pylist(), strict=True) if y is not None], find, rounds, pseudo) for t in TARGETS}


def _judged(rows: DataFrame, judges: dict[str, Judge], reject_at: float, sets_of: Callable) -> DataFrame:
    more, schema = carried(rows)

    def score(batches):
        for batch in batches:
            sets = sets_of(batch)
            scores = {t: judges[t].probabilities(sets) for t in TARGETS}
            kept = np.all([scores[t] < reject_at for t in TARGETS], axis=0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **{f"p_{t}": pa.array(scores[t], pa.float64()) for t in TARGETS}, "kept": pa.array(kept, pa.bool_())} | {c: batch.column(c) for c in more})

    return unpacked(map_arrow(rows, score, f"doc_id long, p_low_quality double, p_toxic double, kept boolean{schema}"))


def judge(df: DataFrame, judges: dict[str, Judge], reject_at: float = 0.5, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, kept) of each row of ``df``, and the
    columns ``keep``."""
    own = ("text", "lang", "source", "length")
    return _judged(_rows(df, id_col, text_col, keep), judges, reject_at, lambda batch: [_views(*x) for x in zip(*(batch.column(c).to_pylist() for c in own), strict=True)])


def classify(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled rows of ``df`` and judge all of its rows."""
    columns = {k: options[k] for k in ("id_col", "text_col") if k in options}
    found = materialize(features(df, **columns), "classifier-features")
    return _judged(found, fit(df, labels, found=found, **options), 0.5, _sets)
