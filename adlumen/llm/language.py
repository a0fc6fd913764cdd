"""Operator 2: language identification by nearest centroids of TF-IDF n-gram vectors.

Letters of a text in lower case, with every other run of characters as one space, give n-grams of
one to three characters, told apart by their code points. A text's vector is (1 + ln count) * idf,
normalised. Every language has ``CLUSTERS`` centroids from spherical k-means over its training
vectors; a text gets the language of the centroid with the largest cosine, its score.

A text is rejected if it has no letters or is too far from every centroid. How near texts of a
language are depends on their length, up to some hundred letters, so the training texts are also cut
to their first 4, 8, 16, ... letters. The cosines of one language and length class, each with the
centroids as they are without its own text, give the class its limit, half of their ``LOW`` quantile:
texts of one word said again and again stay over it, random letters of that length do not reach it.
N-grams that the model does not hold count in a text's norm and never meet by a hash, so a long text
in no known language stays as far as a short one.

The model is fitted on at most ``PER_LANGUAGE`` distinct labelled texts of each language, those with
the smallest hashes, so copies neither fill nor empty the sample; its size is languages * CLUSTERS *
``GRAMS`` numbers at most, as the languages' n-grams in most texts are held, in turn. Prediction is one scan.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from adlumen.llm import common as c

GRAMS = 1 << 16
CLUSTERS = 3
PER_LANGUAGE = 400
LOW = 0.01
# With fewer cosines of a language in a length class, those of all languages give the limit.
ENOUGH = 50
# Length classes by powers of two; the last one holds all texts of 256 letters and more.
CLASSES = 10
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    if not _letters:
        table = np.full(0x110000, 32, np.uint32)
        for code in range(0x110000):
            if (ch := chr(code)).isalpha():
                low = ch.lower()
                table[code] = ord(low) if len(low) == 1 else ord(unicodedata.normalize("NFD", low)[0])
        _letters.append(table)
    return _letters[0]


def letters(text: str | None) -> np.ndarray:
    """The code points of a text's letters in lower case, each other run and both ends as one space;
    empty without letters."""
    codes = _folded()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
    solid = codes != 32
    if not solid.any():
        return np.zeros(0, np.int64)
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    line = np.concatenate([[np.uint32(32)], codes[keep]])
    return line.astype(np.int64)


def features(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a line of letters, as whole numbers in order, and their counts."""
    two = line[:-1] | line[1:] << 21
    three = two[:-1] | line[2:] << 42
    grams = np.sort(np.concatenate([line[line != 32], two, three]))
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.diff(np.concatenate([first, [len(grams)]]))


def length_class(line: np.ndarray) -> int:
    return min(len(line).bit_length(), CLASSES - 1)


def beginnings(line: np.ndarray) -> Iterator[np.ndarray]:
    """The line and its beginnings of all smaller length classes, at a word's end where there is one."""
    yield line
    size = 1 << (length_class(line) - 1)
    while size > 2:
        part = line[:size]
        ends = np.flatnonzero(part == 32)
        end = int(ends[-1]) + 1 if len(ends) > 1 and ends[-1] >= size // 2 else size
        yield line[:end]
        size //= 2


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # in order
    centroids: np.ndarray  # a column for each centroid
    of: np.ndarray  # the language of each centroid
    idf: np.ndarray
    other: float  # the idf of all other n-grams
    limits: np.ndarray  # the smallest cosine that is not rejected, for each language and length class

    def vector(self, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of the n-grams that the model holds, normalised with all others."""
        near = np.minimum(np.searchsorted(self.grams, grams), max(0, len(self.grams) - 1))
        held = self.grams[near] == grams
        weights = (1 + np.log(counts)) * np.where(held, self.idf[near], self.other)
        return near[held], weights[held] / np.sqrt(weights @ weights)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the text is rejected."""
        line = letters(text)
        if not len(line) or not self.languages:
            return UNKNOWN, 0.0, True
        at, weights = self.vector(*features(line))
        cosines = weights @ self.centroids[at]
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[self.of[best]], score, score <= 0 or score < self.limits[self.of[best], length_class(line)]


def _limits(languages: int, scores: dict[tuple[int, int], list[float]]) -> np.ndarray:
    """The limit of each language and length class from cosines of training texts. Classes without
    any take the limit of the next shorter one that has some, or else of the shortest."""
    out = np.full((languages, CLASSES), np.nan)
    for kind in range(CLASSES):
        everything = [x for k in range(languages) for x in scores.get((k, kind), ())]
        for k in range(languages):
            own = scores.get((k, kind), ())
            own = own if len(own) >= ENOUGH else everything
            if own:
                out[k, kind] = np.quantile(own, LOW) / 2
    known = np.flatnonzero(~np.isnan(out[0])) if languages else ()
    if not len(known):
        return np.zeros((languages, CLASSES))
    return out[:, [int(known[max(0, np.searchsorted(known, kind, "right") - 1)]) for kind in range(CLASSES)]]


def _clusters(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far apart starts: centroids and the cluster of each vector."""
    starts = [vectors.mean(axis=0)]
    starts[0] = vectors[int(np.argmax(vectors @ starts[0]))]
    while len(starts) < min(k, len(vectors)):
        starts.append(vectors[int(np.argmin((vectors @ np.array(starts).T).max(axis=1)))])
    centroids = np.array(starts)
    for _ in range(12):
        member = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.array([vectors[member == j].sum(axis=0) if (member == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def smallest_hashes(hashes: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest distinct values of h for each language of ``hashes (lang, h)``, as rows
    (lang, h). Tasks keep ``k`` values of each language, and so do both steps that merge them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, np.ndarray] = {}
        for one in batches:
            coded = one.column("lang").dictionary_encode()
            codes, values = coded.indices.to_numpy(zero_copy_only=False), one.column("h").to_numpy()
            for code, lang in enumerate(coded.dictionary.to_pylist()):
                found = values[codes == code]
                least[lang] = np.unique(np.concatenate([least[lang], found]) if lang in least else found)[:k]
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.string()), pa.array([x.tolist() for x in least.values()], pa.list_(pa.int64()))], ["lang", "hs"])

    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hs")))), 1, k).alias("hs")
    parts = hashes.mapInArrow(run, "lang string, hs array<long>").withColumn("part", F.spark_partition_id() % 32)
    return parts.groupBy("lang", "part").agg(merged).groupBy("lang").agg(merged).select("lang", F.explode("hs").alias("h"))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model from labelled rows; those without a text, letters or a language are no examples.

    At most ``per_language`` distinct texts of each language are used, those with the smallest
    hashes, so neither the order of rows nor the number of their copies matters. Without any example
    the model knows no language.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.col(lang) != UNKNOWN)).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    # At most ``per_language`` rows of each language.
    nothing = Model([], np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0, np.int64), np.zeros(0), 0.0, np.zeros((0, CLASSES)))
    drawn = rows.join(F.broadcast(smallest_hashes(rows.select("lang", "h"), per_language)), ["lang", "h"], "left_semi")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[str, int]] = set()
        for one in batches:
            keys = list(zip(one.column("lang").to_pylist(), one.column("h").to_pylist()))
            fresh = [i for i, key in enumerate(keys) if not (key in known or known.add(key))]
            lines = [letters(one.column("text")[i].as_py()) for i in fresh]
            of, nth, kinds, at, n = [], [], [], [], []
            for i, line in zip(fresh, lines):
                for number, part in enumerate(beginnings(line) if len(line) else ()):
                    grams, counts = features(part)
                    of.append(i)
                    nth.append(number)
                    kinds.append(length_class(part))
                    at.append(grams.tobytes())
                    n.append(counts.astype(np.int32).tobytes())
            whose = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([one.column("lang").take(whose), one.column("h").take(whose), pa.array(nth, pa.int32()), pa.array(kinds, pa.int32()), pa.array(at, pa.binary()), pa.array(n, pa.binary())], ["lang", "h", "nth", "kind", "at", "n"])

    found = drawn.select("lang", "h", "text").mapInArrow(vectors, "lang string, h long, nth int, kind int, at binary, n binary")
    # Tasks send a text once, and copies of several tasks meet here.
    once = found.groupBy("lang", "h", "nth").agg(F.min(F.struct("kind", "at", "n")).alias("v")).select("lang", "h", "nth", "v.*")
    chosen: dict[str, dict[int, list]] = {}
    for row in sorted(once.collect(), key=lambda r: r[:3]):
        chosen.setdefault(row["lang"], {}).setdefault(row["h"], []).append((row["kind"], np.frombuffer(row["at"], np.int64), np.frombuffer(row["n"], np.int32)))
    if not chosen:
        return nothing
    languages = sorted(chosen)
    total = sum(map(len, chosen.values()))
    # The languages' n-grams in most texts, in turn, up to the bound.
    held = []
    for k in languages:
        grams, texts = np.unique(np.concatenate([parts[0][1] for parts in chosen[k].values()]), return_counts=True)
        order = np.lexsort((grams, -texts))[:GRAMS]
        held.append((grams[order], texts[order], np.arange(len(order))))
    every, texts, turn = (np.concatenate(x) for x in zip(*held))
    grams, whose = np.unique(every[np.lexsort((every, turn))], return_index=True)
    grams = np.sort(grams[np.argsort(whose, kind="stable")][:GRAMS])
    seen = np.zeros(len(grams))
    near = np.minimum(np.searchsorted(grams, every), len(grams) - 1)
    np.add.at(seen, near[grams[near] == every], texts[grams[near] == every])
    model = Model(languages, grams, np.zeros((len(grams), 0)), np.zeros(0, np.int64), np.log((1 + total) / (1 + seen)) + 1, float(np.log(1 + total)) + 1, np.zeros((len(languages), CLASSES)))

    means, of, sums, members = [], [], [], []
    for number, k in enumerate(languages):
        block = np.zeros((len(chosen[k]), len(grams)), np.float32)
        for i, parts in enumerate(chosen[k].values()):
            at, weights = model.vector(*parts[0][1:])
            block[i, at] = weights
        block /= np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-12)
        centroids, member = _clusters(block, CLUSTERS)
        members.append(member + len(of))
        for j, mean in enumerate(centroids):
            means.append(mean)
            sums.append(block[member == j].sum(axis=0))
            of.append(number)
    model.centroids, model.of = np.array(means, np.float32).T.copy(), np.array(of)
    # Cosines of the training texts and their beginnings, a text's own part taken out of its centroid.
    scores: dict[tuple[int, int], list[float]] = {}
    for number, k in enumerate(languages):
        for own, parts in zip(members[number].tolist(), chosen[k].values()):
            at, weights = model.vector(*parts[0][1:])
            rest = sums[own].copy()
            rest[at] -= weights / max(np.linalg.norm(weights), 1e-12)
            size = np.linalg.norm(rest)
            if size < 1e-3 and of.count(number) == 1:
                continue  # the only text of its language
            for kind, *gram_counts in parts:
                at, weights = model.vector(*gram_counts)
                cosines = weights @ model.centroids[at]
                cosines[own] = weights @ rest[at] / size if size >= 1e-3 else 0.0
                scores.setdefault((number, kind), []).append(float(cosines.max()))
    model.limits = _limits(len(languages), scores)
    return model


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred (string), score (double, 0 to 1) and rejected (boolean) to every row.

    A text that is null or has no letters, or any text where the model knows no language, gets
    ``und`` and score 0 and is rejected. Other columns pass through; those of these three names are
    replaced. An empty table gives an empty result.
    """
    documents = documents.drop("lang_pred", "score", "rejected")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = [f.name for f in documents.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            found = [shared.value.predict(t) for t in one.column(text).to_pylist()]
            lang, score, rejected = (pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_())))
            yield pa.RecordBatch.from_arrays([*one.columns, lang, score, rejected], [*kept, "lang_pred", "score", "rejected"])

    schema = T.StructType(list(documents.schema.fields)).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return documents.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predictions(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row of ``documents (doc_id, text,
    lang)``, from a model that learned from rows that are not held out. A null doc_id is not held
    out."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").withColumn("held_out", held_out())
    model = fit(rows.where("not held_out"))
    return identify(rows.select("doc_id", "held_out", "text"), model).drop("text")
