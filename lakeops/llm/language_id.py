"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte of a text gets a probability for each language from the states of
two gated recurrent layers, one reading forwards and one backwards. The
document's probabilities are the mean over its positions. The network is
trained here, in numpy, by backpropagation through time.

Long texts are read in windows of ``WINDOW`` bytes that cover every byte;
states start anew in each window, so a text of any length costs its bytes
and no more, and windows of many documents advance in step as one matrix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, slices_by_bytes, utf8

WINDOW = 256                 # bytes per window when predicting
PAD = 256                    # beside the 256 byte values; leaves states untouched
UNDETERMINED = "und"
HAS_LETTER = r"\p{L}"


def _squash(x: np.ndarray) -> np.ndarray:
    """Logistic function in place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class ByteGru:
    """Parameters and the two passes. Axis 0 of each array is the direction.

    ``table``: input contribution of each byte to update gate, reset gate and
    candidate; ``inner``: recurrent weights; ``head``: state to language.
    """

    def __init__(self, languages: list[str], hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        scale = 1 / np.sqrt(hidden)
        self.p = {"table": rng.normal(0, 0.3, (2, 256, 3 * hidden)), "inner": rng.normal(0, scale, (2, hidden, 3 * hidden)),
                  "head": rng.normal(0, scale, (2, hidden, len(languages))), "bias": np.zeros(len(languages))}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _table(self) -> np.ndarray:
        pad = np.zeros((2, 1, 3 * self.hidden), np.float32)
        pad[..., :self.hidden] = 1e4         # update gate 1: keep the state
        return np.concatenate([self.p["table"], pad], axis=1)

    def _fast(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Tables and recurrent weights per gate, forward rows before backward rows.

        sigmoid(x) = (1 + tanh(x / 2)) / 2: the halves are folded into the
        gates' weights, and the reset gate's into the candidate's weights.
        """
        h = self.hidden
        flat = self._table().reshape(2 * (PAD + 1), 3 * h)
        scale = (0.5, 0.5, 1.0), (0.5, 0.5, 0.5)
        return ([np.ascontiguousarray(flat[:, k * h:(k + 1) * h] * np.float32(scale[0][k])) for k in range(3)],
                [np.ascontiguousarray(self.p["inner"][..., k * h:(k + 1) * h] * np.float32(scale[1][k])) for k in range(3)])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """``(steps, rows, languages)``: each position's probabilities, of windows ``(rows, steps)`` of bytes and PAD."""
        rows, steps = windows.shape
        tables, inner = self._fast()
        head = self.p["head"]
        both = np.concatenate([windows.T, windows.T[::-1] + (PAD + 1)], axis=1).astype(np.intp)
        shape = (2, rows, self.hidden)
        state, spare = np.zeros(shape, np.float32), np.empty(shape, np.float32)
        update, reset, candidate = (np.empty(shape, np.float32) for _ in range(3))
        out = np.zeros((steps, rows, len(self.languages)), np.float32)
        out += self.p["bias"]
        for t in range(steps):
            for gate, table, weights in zip((update, reset), tables, inner):
                np.take(table, both[t], axis=0, out=gate.reshape(2 * rows, -1), mode="clip")
                gate += np.matmul(state, weights, out=spare)
                np.tanh(gate, out=gate)
                gate += 1
            np.take(tables[2], both[t], axis=0, out=candidate.reshape(2 * rows, -1), mode="clip")
            reset *= np.matmul(state, inner[2], out=spare)
            candidate += reset
            np.tanh(candidate, out=candidate)
            update *= 0.5
            state -= candidate
            state *= update
            state += candidate
            seen = np.matmul(state, head)
            out[t] += seen[0]
            out[steps - 1 - t] += seen[1]
        np.clip(out, -60, 60, out=out)
        np.exp(out, out=out)
        out /= (out.reshape(-1, out.shape[2]) @ np.ones((out.shape[2], 1), np.float32)).reshape(steps, rows, 1)
        return out

    def train_step(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions, each labelled with its window's language, and its gradient."""
        rows, steps = windows.shape
        h, p, table = self.hidden, self.p, self._table()
        both = np.stack([windows.T, windows.T[::-1]], axis=1)
        state, kept = np.zeros((2, rows, h), np.float32), []
        out = np.zeros((steps, rows, len(self.languages)), np.float32) + p["bias"]
        side = np.arange(2)[:, None]
        for t in range(steps):
            x, u = table[side, both[t]], state @ p["inner"]
            z, r = (_squash(x[..., k * h:(k + 1) * h] + u[..., k * h:(k + 1) * h]) for k in (0, 1))
            inner = u[..., 2 * h:]
            n = np.tanh(x[..., 2 * h:] + r * inner)
            new = z * state + (1 - z) * n
            kept.append((state, z, r, n, inner, new))
            state = new
            seen = new @ p["head"]
            out[t] += seen[0]
            out[steps - 1 - t] += seen[1]
        out -= out.max(axis=2, keepdims=True)
        prob = np.exp(out)
        prob /= prob.sum(axis=2, keepdims=True)
        real = (windows.T != PAD)[..., None]
        weight = real / real.sum()
        at = np.take_along_axis(prob, labels[None, :, None], axis=2)
        loss = float(-(np.log(at + 1e-9) * weight).sum())
        d_out = prob
        np.put_along_axis(d_out, labels[None, :, None], at - 1, axis=2)
        d_out = (d_out * weight).astype(np.float32)

        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["bias"] = d_out.sum(axis=(0, 1))
        d_state = np.zeros((2, rows, h), np.float32)
        for t in range(steps - 1, -1, -1):
            old, z, r, n, inner, new = kept[t]
            d_seen = np.stack([d_out[t], d_out[steps - 1 - t]])
            grad["head"] += new.transpose(0, 2, 1) @ d_seen
            d_state = d_state + d_seen @ p["head"].transpose(0, 2, 1)
            d_n = d_state * (1 - z) * (1 - n * n)
            d_z = d_state * (old - n) * z * (1 - z)
            d_r = d_n * inner * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_n], axis=2)
            d_u = np.concatenate([d_z, d_r, d_n * r], axis=2)
            for k in (0, 1):
                byte = both[t, k] < PAD
                np.add.at(grad["table"][k], both[t, k][byte], d_x[k][byte])
            grad["inner"] += old.transpose(0, 2, 1) @ d_u
            d_state = d_state * z + d_u @ p["inner"].transpose(0, 2, 1)
        return loss, grad

    def fit(self, windows: np.ndarray, labels: np.ndarray, steps: int = 200, batch: int = 128,
            rate: float = 0.02, seed: int = 11) -> "ByteGru":
        """Adam with gradient clipping over batches balanced by language; the same sample gives the same network."""
        rng = np.random.default_rng(seed)
        pools = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        share = -(-batch // len(pools))
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(pool, share) for pool in pools])
            _, grad = self.train_step(windows[pick], labels[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] -= (now * (first[k] / (1 - 0.9 ** step))
                              / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return self

    def document_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """``(texts, languages)``: mean of the position probabilities; zero rows for texts without bytes."""
        pieces = [-(-len(t) // WINDOW) for t in texts]
        owner = np.repeat(np.arange(len(texts)), pieces)
        windows = np.full((len(owner), WINDOW), PAD, np.int16)
        flat, row = windows.reshape(-1), 0
        for text, n in zip(texts, pieces):
            flat[row * WINDOW:row * WINDOW + len(text)] = np.frombuffer(text, np.uint8)
            row += n
        total = np.zeros((len(texts), len(self.languages)))
        # windows of like length together: the last ones of texts cost no more than they hold
        order = np.argsort(-(windows != PAD).sum(axis=1), kind="stable")
        for at in range(0, len(order), 1024):
            rows = order[at:at + 1024]
            part = windows[rows]
            real = part != PAD
            used = int(real.sum(axis=1).max())
            prob = self.probabilities(part[:, :used])
            pooled = np.einsum("trc,tr->rc", prob, real[:, :used].T.astype(np.float32))
            np.add.at(total, owner[rows], pooled)
        size = np.array([max(1, len(t)) for t in texts])[:, None]
        return total / size


def held_out(id_col: str) -> Column:
    """A quarter of the rows, by the checksum of the id as text; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 600, window: int = 64, **fit) -> ByteGru | None:
    """Fit on a bounded sample of the labelled rows that are not held out.

    Bound: about ``per_language`` windows of ``window`` bytes for each
    language, however many there are; rows are chosen by a hash of id and
    text, the window's place by another. None if nothing is labelled.
    """
    usable = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.rlike(F.col(text_col), F.lit(HAS_LETTER)))
    counts = usable.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    # one struct of all languages, as one literal of the sampling plan
    told = F.map_from_entries(F.collect_list(F.struct("lang", F.least(F.lit(1.0), 1.15 * per_language / F.col("n")))))
    share = counts.agg(told.alias("share")).scalar()
    text = utf8(F.col(text_col))
    draw = F.xxhash64(F.lit("row"), F.col(id_col).cast("string"), F.col(text_col))
    place = F.pmod(F.xxhash64(F.lit("place"), F.col(text_col)), F.greatest(F.octet_length(text) - window, F.lit(0)) + 1)
    sample = (usable.where((F.pmod(draw, F.lit(1 << 20)) < share[F.col(lang_col)] * (1 << 20)))
              .select(F.col(lang_col).alias("lang"), F.substring(text, (place + 1).cast("int"), F.lit(window)).alias("bytes"))
              .collect())
    sample = sorted((r["lang"], bytes(r["bytes"])) for r in sample)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    windows = np.full((len(sample), window), PAD, np.int16)
    for i, (_, data) in enumerate(sample):
        windows[i, :len(data)] = np.frombuffer(data, np.uint8)
    labels = np.array([languages.index(lang) for lang, _ in sample])
    return ByteGru(languages).fit(windows, labels, **fit)


def predict(docs: DataFrame, model: ByteGru | None, text_col: str = "text", label: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` with all its columns plus ``label`` and ``score``; no shuffle.

    NULL text and text without a letter: ``und`` with score 0; so is every
    row if there was nothing to learn from. Ties go to the first language in
    alphabetical order. Whole texts are read; language, source and id are no
    inputs. New columns must not exist yet.
    """
    clash = {label, score} & set(docs.columns)
    if clash:
        raise ValueError(f"columns to be added exist already: {sorted(clash)}")
    ready = docs.withColumn(free_name(docs, "input"), F.when(F.rlike(F.col(text_col), F.lit(HAS_LETTER)), utf8(F.col(text_col))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, -1, 2 << 20):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            letters = np.array([t is not None for t in texts], bool)
            names, best = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            if model is not None and letters.any():
                prob = model.document_probabilities([t for t in texts if t is not None])
                top = prob.argmax(axis=1)
                names[letters] = np.array(model.languages, object)[top]
                best[letters] = np.clip(prob[np.arange(len(top)), top], 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(best)],
                                             [*batch.schema.names[:-1], label, score])

    schema = T.StructType([*docs.schema.fields, T.StructField(label, T.StringType()),
                           T.StructField(score, T.DoubleType())])
    return ready.mapInArrow(run, schema)


__all__ = ["ByteGru", "train", "predict", "held_out", "UNDETERMINED"]
