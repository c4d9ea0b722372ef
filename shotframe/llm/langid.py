"""Language ID by hierarchical discrimination: linear machines vote for a language family first, then
one-versus-one linear support vector machines tell the languages within it apart."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import text_chunks

#: Families by ISO 639-1 code; a language that is not here is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "celtic": ("br", "cy", "ga"),
}
#: Hashed features: byte bigrams and trigrams, each in half of the space.
DIMS = 1 << 13
_LETTER = regex.compile(r"\p{L}")
#: The trigram of three spaces, which tells nothing.
_BLANK = 0x202020
#: From so many texts of a language on, a trigram is known if two of them hold it: one odd text makes nothing known.
ENOUGH_TEXTS = 20


def family(lang: str) -> str:
    return next((k for k, v in FAMILIES.items() if lang in v), lang)


def _raw_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bigram and the trigram from each byte on, and where each text begins.
    Texts are framed by spaces; A-Z count as a-z, and digits and white space as spaces."""
    joined = b"".join(b"  " + t.lower() + b" " for t in texts) + b"  "  # no gram reaches into the next text's letters
    buf = np.frombuffer(joined, np.uint8)
    buf = np.where((buf < 65) & (buf != 39), 32, buf).astype(np.uint32)
    begins = np.concatenate(([0], np.cumsum([len(t) + 3 for t in texts])))
    two = buf[:-2] << np.uint32(8) | buf[1:-1]
    return two, two << np.uint32(8) | buf[2:], begins


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of the bigram and of the trigram from each byte on, and where each text begins."""
    two, three, begins = _raw_grams(texts)
    half, shift = DIMS // 2, np.uint32(32 - (DIMS // 2).bit_length() + 1)
    return (two * np.uint32(2654435761)) >> shift, ((three * np.uint32(2246822519)) >> shift) + np.uint32(half), begins


def _counts(text: bytes) -> tuple[bytes, bytes]:
    """The text's features: their numbers, and relative frequencies scaled to a length of about one."""
    two, three, _ = _grams([text])
    x = np.bincount(two, minlength=DIMS) + np.bincount(three, minlength=DIMS)
    at = np.flatnonzero(x)
    return at.astype(np.uint16).tobytes(), (x[at] / len(two)).astype(np.float16).tobytes()


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 80, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear support vector machine, squared hinge loss, by accelerated gradient descent; classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    a, speed = w.copy(), 1.0
    # the largest curvature, by power iteration
    v = np.ones(x.shape[1], np.float32) / np.sqrt(x.shape[1])
    for _ in range(8):
        u = x.T @ (weight * (x @ v))
        top = float(np.linalg.norm(u))
        v = u / max(top, 1e-12)
    rate = 1 / (2 * (top + 1) + decay)
    for _ in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ a[:-1] + a[-1])) * weight * y
        grad = np.concatenate((-2 * (x.T @ gap) + decay * a[:-1], [-2 * gap.sum()])).astype(np.float32)
        nxt = a - rate * grad
        fresh = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        a, w, speed = nxt + (speed - 1) / fresh * (nxt - w), nxt, fresh
    return w[:-1], float(w[-1])


class Tree:
    """The families, and in each its languages, with a machine for every two of them."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.known: dict[str, np.ndarray] = {}  # trigrams of each language
        self.families = sorted({family(v) for v in langs})
        self.members = {f: [v for v in langs if family(v) == f] for f in self.families}
        self.pairs = [p for names in (self.families, *self.members.values()) for p in combinations(names, 2)]  # of families, then of languages
        self.weights = np.zeros((len(self.pairs), DIMS), np.float32)
        self.bias = np.zeros(len(self.pairs))

    def duties(self, lang: str) -> list[tuple[int, int, float]]:
        """Machines that learn from the language: number, its side, and the share of its sample: a family's
        languages send so much that a side has two languages' samples at most."""
        kin = family(lang)
        share = min(1.0, 2 / len(self.members[kin]))
        of_family = [(k, 1 if kin == self.pairs[k][0] else -1, share) for k in range(len(self.families) * (len(self.families) - 1) // 2) if kin in self.pairs[k]]
        first = len(self.families) * (len(self.families) - 1) // 2
        return of_family + [(k, 1 if lang == self.pairs[k][0] else -1, 1.0) for k in range(first, len(self.pairs)) if lang in self.pairs[k]]

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the score is the product of the two steps' shares, from 0 to 1."""
        if not texts:
            return [], np.zeros(0)
        two, three, begins = _grams(texts)
        sizes = np.diff(begins)
        margins = np.empty((len(texts), len(self.pairs)))
        for k, w in enumerate(self.weights):
            margins[:, k] = np.add.reduceat((w[two] + w[three]).astype(np.float64), begins[:-1]) / sizes + self.bias[k]
        votes = 1 / (1 + np.exp(-4 * np.clip(margins, -30, 30)))
        index = {p: i for i, p in enumerate(self.pairs)}

        def share(names: list[str]) -> np.ndarray:
            """Of each name, its mean vote against the others."""
            out = np.ones((len(texts), len(names)))
            if len(names) > 1:
                out[:] = 0
                for i, j in combinations(range(len(names)), 2):
                    v = votes[:, index[names[i], names[j]]]
                    out[:, i] += v
                    out[:, j] += 1 - v
                out /= len(names) - 1
            return out

        first = share(self.families)
        chosen, score = first.argmax(1), first.max(1)
        langs = np.empty(len(texts), object)
        for f, name in enumerate(self.families):
            at = np.flatnonzero(chosen == f)
            if len(at):
                own = share(self.members[name])[at]
                langs[at] = np.array(self.members[name], object)[own.argmax(1)]
                score[at] *= own.max(1)
        return langs.tolist(), score

    def known_shares(self, texts: list[bytes], langs: list[str]) -> np.ndarray:
        """Of each text, the share of its trigrams that its language is known to have, from 0 to 1. Votes only
        compare languages, so this alone tells a text that none of them fits."""
        out, names = np.zeros(len(texts)), np.array(langs, object)
        for v in sorted(set(langs)):
            at = np.flatnonzero(names == v)
            _, three, begins = _raw_grams([texts[i] for i in at])
            told = three[: begins[-1]] != _BLANK
            hit = np.isin(three[: begins[-1]], self.known.get(v, np.empty(0, np.uint32)), kind="table") & told
            out[at] = np.add.reduceat(hit, begins[:-1], dtype=np.int64) / np.maximum(1, np.add.reduceat(told, begins[:-1], dtype=np.int64))
        return out


def fit(docs: DataFrame, per_language: int = 250, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Tree:
    """Learns from a sample of about per_language rows of each language (rows with null lang or text are left
    out): those whose hash of id and text falls below the share that is needed, so the sample does not depend on
    the order of rows, nor on ids that are null or repeat; repeated texts of a language count once. Each machine is fitted by a task of its own, from two samples a side at most; the driver gets
    its DIMS weights, and of each language the trigrams that it knows."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy("lang").collect()}
    langs = sorted(sizes)
    if not langs:
        return Tree([])
    tree = Tree(langs)
    share = F.coalesce(*[F.when(F.col("lang") == v, F.lit(min(1.0, per_language / sizes[v]))) for v in langs])
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit(0)), F.lit("langid"), "text"), F.lit(1 << 30)) / float(1 << 30)
    duties = {v: tree.duties(v) for v in langs}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each machine that learns from a text, and one (machine -1 - k) for what language k knows."""
        for names, texts in text_chunks(batches):
            rows = []
            for v, t in zip(names, texts, strict=True):
                at, x = _counts(t)
                rows += [(k, side, at, x) for k, side, part in duties[v] if part == 1 or zlib.crc32(t) < part * (1 << 32)]
                rows.append((-1 - langs.index(v), 0, np.unique(_raw_grams([t])[1]).tobytes(), b""))
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows[i : i + 256], strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["machine", "side", "at", "x"])

    def learned(t: pa.Table) -> pa.Table:
        machine, at, x = t.column("machine")[0].as_py(), t.column("at").to_pylist(), t.column("x").to_pylist()
        if machine < 0:
            grams, texts = np.unique(np.concatenate([np.frombuffer(v, np.uint32) for v in at]), return_counts=True)
            w, c = grams[texts >= (2 if len(at) >= ENOUGH_TEXTS else 1)], 0.0
        else:
            y, dense = np.array(t.column("side").to_pylist(), np.float32), np.zeros((len(at), DIMS), np.float32)
            order = sorted(range(len(at)), key=lambda i: (y[i], at[i], x[i]))  # the same machine whatever order the rows come in
            for row, i in enumerate(order):
                dense[row, np.frombuffer(at[i], np.uint16)] = np.frombuffer(x[i], np.float16)
            scale = float(np.sqrt(np.square(dense).sum(1).mean())) or 1.0
            dense /= scale
            w, c = _machine(dense, y[order])
            w = (w / scale).astype(np.float32)
        return pa.table({"machine": pa.array([machine], pa.int32()), "w": pa.array([w.tobytes()], pa.binary()), "bias": pa.array([c], pa.float64())})

    rows = known.where(draw < share).select("lang", "text").distinct().mapInArrow(features, "machine int, side int, at binary, x binary")
    for machine, w, bias in zip(*(c.to_pylist() for c in rows.groupBy("machine").applyInArrow(learned, "machine int, w binary, bias double").toArrow().columns), strict=True):
        if machine < 0:
            tree.known[langs[-1 - machine]] = np.frombuffer(w, np.uint32)
        else:
            tree.weights[machine], tree.bias[machine] = np.frombuffer(w, np.float32), bias
    return tree


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def language_id(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Predicted language of every whole text: id, lang_pred, score (0 to 1) and known (share of the text's
    trigrams that the language is known to have), one row per row of docs, after it the columns of keep.

    A null text, one without a letter, or a tree that has learned no language give und, 0 and 0. Null ids
    stay null. Only the text is read for a prediction; other columns are not read unless kept. No shuffle;
    the tree, a few machines of DIMS weights, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    kept = [c for c in keep if c != id_col]
    source = docs.select(F.col(id_col).cast("long"), *(F.col(c) for c in kept), *(F.col(c) for c in (text_col,) if c not in kept))
    told = [("lang_pred", StringType()), ("score", DoubleType()), ("known", DoubleType())]
    schema = StructType([StructField(id_col, LongType()), *(source.schema[c] for c in kept), *(StructField(*x) for x in told)])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in batches:
            done = 0
            for ids, texts in text_chunks(iter([batch.select([id_col, text_col])])):
                named = [bool(t.langs) and bool(_LETTER.search(x.decode("utf-8", "replace"))) for x in texts]
                lettered = [x for x, ok in zip(texts, named, strict=True) if ok]
                langs, score = t.predict(lettered)
                it, sc, kn = iter(langs), iter(score.tolist()), iter(t.known_shares(lettered, langs).tolist())
                found = [pa.array([next(it) if ok else "und" for ok in named], pa.string()), *(pa.array([next(x) if ok else 0.0 for ok in named], pa.float64()) for x in (sc, kn))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(done, len(ids)) for c in (id_col, *kept)), *found], [id_col, *kept, *(k for k, _ in told)])
                done += len(ids)

    return source.mapInArrow(predicted, schema)
