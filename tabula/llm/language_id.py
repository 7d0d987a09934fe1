"""Language identification by a bidirectional gated recurrent network over bytes.

Each direction is one layer of gated recurrent units. At every byte the two states give a
probability per language (a label for that position); a document's probabilities are the
mean over all its bytes. Texts are cut into segments of ``SEGMENT`` bytes that run side by
side, each from a zero state, so a text of any length is read whole in bounded memory. The
network is trained in numpy by backpropagation through time, with the document's language
as the target at every position, on a bounded sample of labelled documents.

A text that is null or holds no letter gets ``und`` and score 0, as does every text when
there was nothing to learn from. Ties go to the language that sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import sample_per_label, slices

HIDDEN = 8
SEGMENT = 64
#: Segments that run side by side.
SIDE = 4096
#: The training sample: documents per language (smallest id hash) and characters of each,
#: cut out at a position given by the hash.
TRAIN_DOCS = 300
TRAIN_CHARS = 2_000
STEPS = 300
BATCH = 128
TRAIN_SEGMENT = 40
UNKNOWN = "und"


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGru:
    """Parameters ``p``: per direction an input row per byte (x), the recurrent matrix and its bias
    (u, b) for reset, update and candidate, and the output matrix (w); the output bias (c)."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "x": normal(2, 256, 3 * hidden, scale=0.3),
            "u": normal(2, hidden, 3 * hidden, scale=hidden**-0.5),
            "b": np.zeros((2, 1, 3 * hidden), np.float32),
            "w": normal(2, hidden, len(labels), scale=hidden**-0.5),
            "c": np.zeros(len(labels), np.float32),
        }

    def _states(self, data: np.ndarray, keep: bool = False):
        """Hidden states [T, 2, B, H] of ``data`` [2, B, T] (bytes in each direction's order)."""
        p, h_size = self.p, self.hidden
        _, count, steps = data.shape
        h = np.zeros((2, count, h_size), np.float32)
        states, tape = np.empty((steps, 2, count, h_size), np.float32), []
        u, b, x0, x1 = p["u"], p["b"], p["x"][0], p["x"][1]
        a = np.empty((2, count, 3 * h_size), np.float32)
        for t in range(steps):
            np.take(x0, data[0, :, t], axis=0, out=a[0], mode="clip")
            np.take(x1, data[1, :, t], axis=0, out=a[1], mode="clip")
            v = h @ u
            v += b
            gates = a[..., : 2 * h_size] + v[..., : 2 * h_size]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            r, z = gates[..., :h_size], gates[..., h_size:]
            n = r * v[..., 2 * h_size :]
            n += a[..., 2 * h_size :]
            np.tanh(n, out=n)
            if keep:
                tape.append((h, r, z, n, v[..., 2 * h_size :]))
            h = h - n
            h *= z
            h += n
            states[t] = h
        return states, tape

    def _logits(self, states: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """[B, T, L]: the two directions meet at the same byte."""
        out = states @ self.p["w"]  # [T, 2, B, L]
        steps = states.shape[0]
        if (sizes == steps).all():
            out = out[:, 0] + out[::-1, 1]
            return out.transpose(1, 0, 2) + self.p["c"]
        out = out.transpose(1, 2, 0, 3)
        mirror = np.maximum(sizes[:, None] - 1 - np.arange(steps), 0)
        return out[0] + np.take_along_axis(out[1], mirror[:, :, None], 1) + self.p["c"]

    @staticmethod
    def both_ways(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """[2, B, T]: the bytes of each row, and the same from its last byte back."""
        mirror = np.maximum(sizes[:, None] - 1 - np.arange(rows.shape[1]), 0)
        return np.stack([rows, np.take_along_axis(rows, mirror, 1)])

    def positions(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probabilities [B, T, L] at every byte of ``rows`` [B, T], whose first ``sizes`` bytes count; 0 beyond."""
        states, _ = self._states(self.both_ways(rows, sizes))
        e = self._logits(states, sizes)
        e -= e.max(2, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(2, keepdims=True)
        if (sizes < rows.shape[1]).any():
            e[np.arange(rows.shape[1]) >= sizes[:, None]] = 0
        return e

    def gradients(self, rows: np.ndarray, sizes: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """Mean loss over the bytes of ``rows`` and its gradient, back through time."""
        p, h_size = self.p, self.hidden
        data = self.both_ways(rows, sizes)
        states, tape = self._states(data, keep=True)
        count, steps = rows.shape
        e = self._logits(states, sizes)
        e -= e.max(2, keepdims=True)
        e = np.exp(e)
        e /= e.sum(2, keepdims=True)
        valid = np.arange(steps) < sizes[:, None]
        total = valid.sum()
        own = np.take_along_axis(e, target[:, None, None], 2)[..., 0]
        loss = float(-np.log(own[valid] + 1e-9).mean())
        d = e
        np.put_along_axis(d, target[:, None, None] + np.zeros((1, steps, 1), np.int64), own[..., None] - 1, 2)
        d = (d * valid[..., None] / total).astype(np.float32)
        mirror = np.maximum(sizes[:, None] - 1 - np.arange(steps), 0)
        back = np.zeros_like(d)
        where_b, where_t = np.nonzero(valid)
        back[where_b, mirror[where_b, where_t]] = d[where_b, where_t]
        both = np.stack([d, back])  # [2, B, T, L] in each direction's order
        flat = states.transpose(1, 2, 0, 3).reshape(2, -1, h_size)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["w"] = flat.transpose(0, 2, 1) @ both.reshape(2, count * steps, -1)
        g["c"] = d.sum((0, 1))
        dh_out = both @ p["w"].transpose(0, 2, 1)[:, None]
        dh = np.zeros((2, count, h_size), np.float32)
        for t in range(steps - 1, -1, -1):
            h, r, z, n, vn = tape[t]
            dh = dh + dh_out[:, :, t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * vn * r * (1 - r)
            da = np.concatenate([dr, dz, dn], 2)
            dv = np.concatenate([dr, dz, dn * r], 2)
            g["u"] += h.transpose(0, 2, 1) @ dv
            g["b"] += dv.sum(1, keepdims=True)
            for k in range(2):
                np.add.at(g["x"][k], data[k, :, t], da[k])
            dh = dh * z + dv @ p["u"].transpose(0, 2, 1)
        return loss, g

    def fit(self, texts: list[tuple[str, bytes]], steps: int = STEPS, batch: int = BATCH,
            length: int = TRAIN_SEGMENT, rate: float = 0.02, seed: int = 11) -> BiGru:
        """Adam over random segments, languages drawn evenly."""
        rng = np.random.default_rng(seed)
        by = [[np.frombuffer(t, np.uint8) for lang, t in texts if lang == name and t] for name in self.labels]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            target = rng.integers(len(self.labels), size=batch)
            rows, sizes = np.zeros((batch, length), np.uint8), np.ones(batch, np.int64)
            for i, k in enumerate(target):
                if not by[k]:
                    continue
                own = by[k][rng.integers(len(by[k]))]
                start = rng.integers(max(1, len(own) - length + 1))
                part = own[start : start + length]
                rows[i, : len(part)], sizes[i] = part, len(part)
            _, g = self.gradients(rows, sizes, target)
            lr = rate * min(1.0, 3 * (1 - step / (steps + 1)))
            for k, v in g.items():
                np.clip(v, -1, 1, out=v)
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def pooled(self, texts: list[bytes], segment: int = SEGMENT, side: int = SIDE) -> np.ndarray:
        """Mean probabilities [texts, L] over all bytes of each text; zeros for an empty one."""
        sums, used = np.zeros((len(texts), len(self.labels))), [len(t) for t in texts]
        counts = [-(-n // segment) for n in used]
        owner = np.repeat(np.arange(len(texts)), counts)
        raw = np.frombuffer(b"".join(t.ljust(c * segment, b"\0") for t, c in zip(texts, counts)), np.uint8)
        rows = raw.reshape(-1, segment)
        sizes = np.full(len(owner), segment)
        ends = np.cumsum(counts) - 1
        for i, n in enumerate(used):
            if n:
                sizes[ends[i]] = n - (counts[i] - 1) * segment
        for some in (np.nonzero(sizes == segment)[0], np.nonzero(sizes < segment)[0]):
            for start in range(0, len(some), side):
                part = some[start : start + side]
                np.add.at(sums, owner[part], self.positions(rows[part], sizes[part]).sum(1))
        return sums / np.maximum(used, 1)[:, None]


def held_out(id_col: str):
    """Documents kept from learning: crc32 of the id as text, modulo 5, is 0. Null ids are held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS, steps: int = STEPS) -> BiGru | None:
    """A network learned from rows that are not held out and have a text and a label; None without any."""
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{label_col}`").cast("string").alias("label"), held_out(id_col).alias("held"),
    ).where("not held and label is not null and text is not null")
    picked = sample_per_label(rows, train_docs)
    room = F.greatest(F.length("text") - train_chars, F.lit(0)) + 1
    cut = F.col("text").substr((F.pmod(F.xxhash64("id", "label"), room) + 1).cast("int"), F.lit(train_chars))
    sample = rows.join(F.broadcast(picked.select("id").distinct()), "id", "left_semi").select("id", "label", cut.alias("cut"))
    found = sorted((r.label, r.id, r.cut) for r in sample.collect())
    if not found:
        return None
    return BiGru(sorted({r[0] for r in found})).fit([(label, cut.encode()) for label, _, cut in found], steps)


def predict(df: DataFrame, model: BiGru | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, lang_pred and score (the pooled probability of that language)."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                     held_out(id_col).alias("held_out"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        names = np.array(model.labels, object)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                real = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
                label, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                if real:
                    pooled = model.pooled([texts[i].encode() for i in real])
                    best = pooled.argmax(1)
                    label[real], score[real] = names[best], np.clip(pooled[np.arange(len(real)), best], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(label, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
