"""Quality classifier by co-training of two views.

The text view sees what is written: words and word shapes (hashed), and how often words
follow themselves. The metadata view sees what is stored about the page and never its text:
language, source and number of characters. Each view is a logistic regression. Both start from a bounded labelled sample; in every round both views
score all documents without label, and those that a view is most sure of, per class and
language and source (by their slots), become training rows of the other view. In the end each
view's score is calibrated (Platt) on labelled rows kept apart, the calibrated log-odds are weighted by a last regression on these rows, and the weights
score every document.

The sample of labelled rows (``SEED_DOCS`` per class, those of the smallest id hash) is a bound
of the fit only. The views of the documents without label are written once to the shared folder;
a round reads them in one pass whose tasks report their surest rows only, equal rows once, so
that the driver gets the rows handed over and no others. Without two classes among the
labels there is nothing to learn: the score is the share of good labels, or 1 without labels.

Null and empty texts have no words and score like any other text of length 0. Null language, source
and length are values of their own. Rows are scored one by one.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.common import releasing, sample_per_label, slices, small_side, workspace

SEED_DOCS = 800
ROUNDS = 4
#: Pseudo-labels that each view hands over per round and class, dealt over the groups of language
#: and source; every group hands over PER_GROUP if it has as many.
PER_ROUND, PER_GROUP = 60, 2
#: A view hands over only labels with at least this probability.
SURE = 0.9
#: Every CALIBRATE-th labelled row is kept apart for calibration.
CALIBRATE = 4
#: A document is kept from this score on.
THRESHOLD = 0.5
WORD_SLOTS, SHAPE_SLOTS, LANG_SLOTS, SOURCE_SLOTS = 1024, 256, 64, 256
#: Steps of the length: powers of two, the last one for an unknown length.
LENGTH_SLOTS = 40
#: Words a task remembers; over it, and when the task ends, the memory is emptied.
MEMORY = 150_000
#: Packed rows that a task takes at a time.
PACKED_ROWS = 1024
TEXT_SIZE = WORD_SLOTS + SHAPE_SLOTS + 2
META_SIZE = LANG_SLOTS + SOURCE_SLOTS + LENGTH_SLOTS + 1
_SHAPES = ((re.compile(r"[^\W\d_]*[a-zß-öø-ÿ][^\W\d_]*"), "x"), (re.compile(r"[^\W\d_a-z]+"), "X"), (re.compile(r"\d+"), "9"))


def _slot(text: str, slots: int) -> int:
    return zlib.crc32(text.encode()) % slots


def _shape(word: str) -> str:
    for pattern, mark in _SHAPES:
        word = pattern.sub(mark, word)
    return word[:8]


class _Slots(dict):
    """Word -> (slot of the word, slot of its shape) as one number."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMORY:
            self.clear()
        value = _slot(word.lower(), WORD_SLOTS) * SHAPE_SLOTS + _slot(_shape(word), SHAPE_SLOTS)
        self[word] = value
        return value


_SLOTS = _Slots()


def _forget() -> None:
    _SLOTS.clear()


def text_view(text: str | None) -> np.ndarray:
    words = text.split() if text else []
    out = np.zeros(TEXT_SIZE, np.float32)
    if not words:
        return out
    both = np.fromiter(map(_SLOTS.__getitem__, words), np.int64, len(words))
    out[:WORD_SLOTS] = np.bincount(both // SHAPE_SLOTS, minlength=WORD_SLOTS)
    out[WORD_SLOTS : WORD_SLOTS + SHAPE_SLOTS] = np.bincount(both % SHAPE_SLOTS, minlength=SHAPE_SLOTS)
    out[: WORD_SLOTS + SHAPE_SLOTS] *= 4 / len(words)
    out[-2] = (both[1:] == both[:-1]).mean() * 4 if len(both) > 1 else 0
    out[-1] = sum(map(len, words)) / len(words) / 8
    return out


def meta_view(lang: str | None, source: str | None, chars: int | None) -> np.ndarray:
    out = np.zeros(META_SIZE, np.float32)
    out[_slot(f"lang={lang}", LANG_SLOTS)] = 0.5
    out[LANG_SLOTS + _slot(f"source={source}", SOURCE_SLOTS)] = 0.5
    rest = out[LANG_SLOTS + SOURCE_SLOTS :]
    known = chars is not None and chars >= 0
    rest[min(int(chars).bit_length(), LENGTH_SLOTS - 2) if known else LENGTH_SLOTS - 1] = 0.5
    rest[LENGTH_SLOTS] = np.log1p(chars) / 10 if known else 0
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 150, rate: float = 0.1):
    """Weights and bias of a logistic regression, classes weighted evenly, by Adam over all rows."""
    w = np.zeros(x.shape[1] + 1)
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], 1)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        g = x.T @ (weight * (_sigmoid(x @ w) - y)) + ridge * np.append(w[:-1], 0)
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
    return w[:-1], w[-1]


@dataclass
class CoTrained:
    """Weights and bias of the text and the metadata view, their calibration (slope, shift), and
    the weights of the calibrated log-odds with the bias that carries the share of good labels."""

    views: list[tuple[np.ndarray, float]]
    calibration: list[tuple[float, float]]
    blend: tuple[float, float, float]

    def score(self, text: str | None, lang: str | None, source: str | None, chars: int | None) -> float:
        total = self.blend[2]
        for (w, b), (slope, shift), part, x in zip(
            self.views, self.calibration, self.blend, (text_view(text), meta_view(lang, source, chars))
        ):
            total += part * (slope * float(x @ w + b) + shift)
        return float(_sigmoid(total))


def _pool(matrices: list[np.ndarray], per_round: int, sure: float):
    """``handed`` over one matrix per view."""
    free = [np.ones(len(matrices[0]), bool) for _ in range(2)]

    def handed(fits):
        made = [[], []]
        for k in range(2 if len(matrices[0]) else 0):
            p, other = _sigmoid(matrices[k] @ fits[k][0] + fits[k][1]), 1 - k
            for good in (1.0, 0.0):
                own = p if good else 1 - p
                rows = np.nonzero(free[other] & (own >= sure))[0]
                rows = rows[np.argsort(-own[rows], kind="stable")[:per_round]]
                free[other][rows] = False
                made[other].append((matrices[other][rows], good))
        return made

    return handed


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool, good_share: float,
             rounds: int = ROUNDS, per_round: int = PER_ROUND, sure: float = SURE) -> CoTrained:
    """``labelled`` holds one matrix per view, and ``pool`` as well; or it is a function that takes the fits of
    both views and returns for either view what it is handed: (matrix, label) pairs."""
    apart = np.arange(len(y)) % CALIBRATE == 0
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart[:] = False
    train = ~apart
    xs, ys = [v[train] for v in labelled], [y[train].copy(), y[train].copy()]
    handed = pool if callable(pool) else _pool(pool, per_round, sure)
    for _ in range(rounds):
        fits = [_regression(x, t) for x, t in zip(xs, ys)]
        for k, parts in enumerate(handed(fits)):
            xs[k] = np.concatenate([xs[k], *(x for x, _ in parts)])
            ys[k] = np.concatenate([ys[k], *(np.full(len(x), good) for x, good in parts)])
    views = [_regression(x, t) for x, t in zip(xs, ys)]
    held = apart if apart.any() else np.ones(len(y), bool)
    calibration, odds = [], []
    for (w, b), v in zip(views, labelled):
        raw = v[held] @ w + b
        slope, shift = _regression(raw[:, None], y[held], ridge=1e-4)
        calibration.append((float(slope[0]), float(shift)))
        odds.append(raw * slope[0] + shift)
    parts, bias = _regression(np.stack(odds, 1), y[held], ridge=1e-2)
    prior = float(np.log(good_share / (1 - good_share)))
    return CoTrained(views, calibration, (float(parts[0]), float(parts[1]), float(bias) + prior))


def _views(df: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and the two matrices of a bounded frame (id, text, lang, source, chars, label), by id hash."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                d = part.to_pydict()
                t = [text_view(x).tobytes() for x in d["text"]]
                m = [meta_view(*x).tobytes() for x in zip(d["lang"], d["source"], d["chars"])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("h"), part.column("label"), pa.array(t, pa.binary()), pa.array(m, pa.binary())],
                    ["h", "label", "t", "m"],
                )

    rows = df.withColumn("h", F.xxhash64("id")).mapInArrow(
        releasing(run, _forget), "h long, label double, t binary, m binary"
    ).collect()
    rows.sort(key=lambda r: (r.h, bytes(r.t)))
    mats = [np.frombuffer(b"".join(r[k] for r in rows), np.float32).reshape(len(rows), -1) for k in ("t", "m")] if rows else [
        np.zeros((0, TEXT_SIZE), np.float32), np.zeros((0, META_SIZE), np.float32)]
    return np.array([r.label for r in rows], float), mats


def _sparse(text: str | None, lang: str | None, source: str | None, chars: int | None) -> tuple[int, bytes]:
    """Group of language and source, and both views in one: places (2 bytes each), then values (4 bytes each)."""
    x = np.concatenate([text_view(text), meta_view(lang, source, chars)])
    at = np.nonzero(x)[0]
    group = _slot(f"lang={lang}", LANG_SLOTS) * SOURCE_SLOTS + _slot(f"source={source}", SOURCE_SLOTS)
    return group, at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes()


def _dense(packed: list[bytes], view: int) -> np.ndarray:
    """The matrix of a view from packed rows."""
    out = np.zeros((len(packed), TEXT_SIZE + META_SIZE), np.float32)
    for row, x in zip(out, packed):
        n = len(x) // 6
        row[np.frombuffer(x, "<u2", n)] = np.frombuffer(x, "<f4", n, 2 * n)
    return out[:, TEXT_SIZE:] if view else out[:, :TEXT_SIZE]


def _odds(packed: list[bytes], fits) -> list[np.ndarray]:
    """Log-odds of packed rows by the fits of both views."""
    sizes = np.array([len(x) // 6 for x in packed], np.int64)
    places = np.concatenate([np.frombuffer(x, "<u2", n) for x, n in zip(packed, sizes)]).astype(np.int64)
    values = np.concatenate([np.frombuffer(x, "<f4", n, 2 * n) for x, n in zip(packed, sizes)])
    rows, out = np.repeat(np.arange(len(packed)), sizes), []
    for view, (w, b) in enumerate(fits):
        full = np.zeros(TEXT_SIZE + META_SIZE)
        full[TEXT_SIZE * view : TEXT_SIZE if view == 0 else None] = w
        out.append(np.bincount(rows, values * full[places], len(packed)) + b)
    return out


def _unlabelled(rows: DataFrame) -> DataFrame:
    """Views of rows (text, lang, source, chars), written once: group, hash of the views, views."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                d = part.to_pydict()
                made = [_sparse(*x) for x in zip(d["text"], d["lang"], d["source"], d["chars"])]
                marks = [int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True) for _, x in made]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for g, _ in made], pa.int32()), pa.array(marks, pa.int64()), pa.array([x for _, x in made], pa.binary())],
                    ["grp", "h", "x"],
                )

    schema = "grp int, h long, x binary"
    path = f"{workspace(rows.sparkSession, 'quality-views')}/unlabelled"
    rows.select("text", "lang", "source", "chars").mapInArrow(releasing(run, _forget), schema).write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def _surest(views: DataFrame, fits, taken: list[set[int]], count: int, sure: float) -> DataFrame:
    """(view, good, x): per view that is handed them, label and group the ``count`` rows that the other view is
    surest of, without those ``taken`` before. Equal rows are one."""
    least = float(np.log(sure / (1 - sure)))
    known = [np.array(sorted(t), np.int64) for t in taken]

    def add(best, packed, h, group):
        for view, odds in enumerate(_odds(packed, fits)):
            free = ~np.isin(h, known[1 - view])
            for good in (1, 0):
                own = odds if good else -odds
                rows = np.nonzero(free & (own >= least))[0]
                full = set()
                for i in rows[np.lexsort((h[rows], -own[rows]))]:
                    if group[i] in full:
                        continue
                    top = best.setdefault((1 - view, good, int(group[i])), {})
                    if int(h[i]) in top:
                        continue
                    if len(top) == count:
                        last = max(top, key=lambda m: (-top[m][0], m))
                        if (-own[i], h[i]) > (-top[last][0], last):
                            full.add(group[i])  # the rows after this one are no surer
                            continue
                        del top[last]
                    top[int(h[i])] = (float(own[i]), packed[i])

    def run(batches):
        best: dict[tuple[int, int, int], dict[int, tuple[float, bytes]]] = {}
        for batch in batches:
            for part in slices(batch, PACKED_ROWS):
                packed, h = part.column("x").to_pylist(), part.column("h").to_numpy()
                add(best, packed, h, part.column("grp").to_numpy())
        rows = [(*key, m, o, x) for key, top in best.items() for m, (o, x) in top.items()]
        kinds = [("view", pa.int32()), ("good", pa.int32()), ("grp", pa.int32()), ("h", pa.int64()), ("own", pa.float64()), ("x", pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, (_, t) in enumerate(kinds)], [n for n, _ in kinds])

    # every task gives at most ``count`` rows of a group, so that no group is large here
    found = views.mapInArrow(releasing(run), "view int, good int, grp int, h long, own double, x binary")
    order = Window.partitionBy("view", "good", "grp").orderBy(F.desc("own"), "h")
    ranked = found.withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= count)
    return ranked.dropDuplicates(["view", "good", "grp", "h"]).select("view", "good", "h", "x")


def _exchange(views: DataFrame, per_round: int = PER_ROUND, per_group: int = PER_GROUP, sure: float = SURE):
    """``handed`` over all rows of ``views``."""
    groups = views.select("grp").distinct().count()
    count, taken = max(per_group, -(-per_round // max(1, groups))), [set(), set()]

    def handed(fits):
        made = [[], []]
        found = sorted(((r.view, -r.good, r.h, bytes(r.x)) for r in _surest(views, fits, taken, count, sure).collect())) if groups else []
        for view in range(2):
            for good in (1, 0):
                rows = [r for r in found if r[:2] == (view, -good)]
                taken[view].update(r[2] for r in rows)
                made[view].append((_dense([r[3] for r in rows], view), float(good)))
        return made

    return handed


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", chars_col: str = "n_chars", label_col: str = "quality", seed_docs: int = SEED_DOCS,
          pool_docs: int | None = None, rounds: int = ROUNDS) -> CoTrained | float:
    """The model, or the share of good labels if there are not two classes to learn from. All documents without
    label take part, or ``pool_docs`` of them if that is given."""
    rows = _named(docs, id_col, text_col, lang_col, source_col, chars_col)
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label")).where(
        "id is not null and label in (0, 1)"
    ).groupBy("id").agg(F.min("label").alias("label"))
    ids = rows.select("id").where("id is not null").distinct()
    there = marks.join(ids, "id")
    share = there.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        return 1.0 if share is None else float(share)
    seed = sample_per_label(there, seed_docs)
    y, seeds = _views(rows.join(F.broadcast(seed), "id").dropDuplicates(["id"]))  # bounded by its parameter
    free = rows.join(small_side(marks.select("id"), 32), "id", "left_anti")
    if pool_docs is not None:
        some = free.select("id").where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(pool_docs)
        free = free.join(F.broadcast(some), "id", "left_semi")
    return co_train(seeds, y, _exchange(_unlabelled(free)), share, rounds)


def _named(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, chars_col: str) -> DataFrame:
    kinds = ((text_col, "text", "string"), (lang_col, "lang", "string"), (source_col, "source", "string"), (chars_col, "chars", "long"))
    return docs.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").cast(kind).alias(n) for c, n, kind in kinds])


def classify(docs: DataFrame, model: CoTrained | float, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", source_col: str = "source", chars_col: str = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: its id, score (probability of good quality) and kept."""
    rows = _named(docs, id_col, text_col, lang_col, source_col, chars_col)
    if isinstance(model, float):
        scored = rows.select(F.col("id").alias(id_col), F.lit(model).alias("score"))
    else:

        def run(batches):
            for batch in batches:
                for part in slices(batch):
                    d = part.to_pydict()
                    score = [model.score(*x) for x in zip(d["text"], d["lang"], d["source"], d["chars"])]
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score, pa.float64())], [id_col, "score"])

        kind = docs.schema[id_col].dataType.simpleString()
        scored = rows.mapInArrow(releasing(run, _forget), f"`{id_col}` {kind}, score double")
    return scored.withColumn("kept", F.col("score") >= threshold)


def accepted(docs: DataFrame, model: CoTrained | float, text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source", chars_col: str = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose own score reaches ``threshold``, with all their columns."""
    if isinstance(model, float):
        return docs if model >= threshold else docs.limit(0)
    names = docs.columns
    # the four values as text and long, at the end, so that no column of ``docs`` can clash
    extra = [F.col(f"`{c}`").cast(t) for c, t in ((text_col, "string"), (lang_col, "string"), (source_col, "string"), (chars_col, "long"))]
    wide = docs.select(*[F.col(f"`{c}`") for c in names], *[c.alias(f"_view_{i}") for i, c in enumerate(extra)])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                values = [part.column(len(names) + i).to_pylist() for i in range(4)]
                keep = pa.array([model.score(*x) >= threshold for x in zip(*values)], pa.bool_())
                yield part.select(list(range(len(names)))).filter(keep)

    return wide.mapInArrow(releasing(run, _forget), docs.schema)
