"""Language identification by interpolated Kneser-Ney character models.

One model of ORDER characters for each language that labels name. Groups of
models share sorted arrays of n-gram keys, with a column of log probabilities for
each language, so one binary search serves a group. A group is as large as a
bound on its tables allows, so that all tables together grow with the n-grams,
not with their product with the languages. Keys are 16 bits for each character,
hence exact for characters of the basic plane. A document gets the language with
the lowest cross-entropy per character. Texts much further from their language
than its calibration documents are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import new_folder, removed, stored
from .shipping import ship

ORDER = 4
SAMPLE_DOCS = 1_000  # labelled documents per language that models are fitted on, about
MOST_LANGUAGES = 10_000  # labels; more are an error, as they hardly name languages
GROUP_NUMBERS = 1 << 21  # of n-grams times languages, in a group of models
CALIBRATION = 5  # each CALIBRATION-th sampled document calibrates
CALIBRATED_DOCS = 40  # sampled documents from which on a language can spare some
QUANTILE = 0.75  # of the calibration documents, so that some wrong labels do nothing
MARGIN = 1.3  # nats per character allowed beyond that
MIN_LETTERS = 50  # shorter texts tell too little to be rejected
EVIDENCE = 40  # characters that count for the score, at most
UNKNOWN = "und"
CHUNK = 1 << 18  # characters scored at once

_EDGE = 1  # code of what comes before a text; white space and signs are 0
_BITS = np.uint64(16)
_CHARACTER = np.uint64(0xFFFF)  # the last one of a key


@cache
def _codes() -> np.ndarray:
    """Code of each character of the basic plane: itself for letters, else 0."""
    table = np.zeros(1 << 16, np.uint64)
    for i in range(2, 1 << 16):
        if chr(i).isalpha():
            table[i] = i
    return table


def encode(text: str) -> np.ndarray:
    """Codes of the lower-cased text, runs of non-letters as one 0; no edges.
    Letters beyond the basic plane fold into it."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = _codes()[points & 0xFFFF]
    beyond = np.flatnonzero(points > 0xFFFF)
    if len(beyond):
        letter = np.array([chr(p).isalpha() for p in points[beyond]])
        folded = 2 + (points[beyond] ^ (points[beyond] >> 16)) % 0xFFFD
        codes[beyond] = np.where(letter, folded, 0)
    if len(codes):
        codes = codes[(codes != 0) | np.r_[True, codes[:-1] != 0]]
    return codes


def ngram_keys(codes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Key of the n-gram that ends at each character, edges before the text."""
    padded = np.concatenate([np.full(order - 1, _EDGE, np.uint64), codes])
    keys = np.zeros(len(codes), np.uint64)
    for i in range(order):
        keys = keys << _BITS | padded[i : i + len(codes)]
    return keys


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted keys, and whether the keys are there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


@dataclass
class Group:
    """Models with shared sorted keys and one column per language.

    log_p[n] are interpolated log probabilities of the n-grams any language has
    seen, log_g[n] log weights of the shorter models after a context.
    """

    languages: list[str]
    keys: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    log_g: list[np.ndarray]
    unseen: float  # log probability of a character that no language has seen

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Summed over the text, for each language."""
        total = np.zeros(len(self.languages))
        keys = ngram_keys(codes)
        for start in range(0, len(keys), CHUNK):
            asked = keys[start : start + CHUNK]
            for n in range(ORDER, 0, -1):
                at, there = _find(self.keys[n], asked)
                # Sums of counts per n-gram would sort first; a gather is cheaper.
                total += self.log_p[n][at[there]].sum(0, dtype=np.float64)
                asked = asked[~there]
                if not len(asked):
                    break
                at, there = _find(self.contexts[n], asked >> _BITS)
                total += self.log_g[n][at[there]].sum(0, dtype=np.float64)
                if n > 1:
                    asked = asked & np.uint64((1 << 16 * (n - 1)) - 1)
                else:
                    total += self.unseen * len(asked)
        return total

    def numbers(self) -> int:
        """Held in its tables."""
        tables = [*self.keys, *self.log_p, *self.contexts, *self.log_g]
        return sum(t.size for t in tables)


@dataclass
class Models:
    """The models of all languages, which are sorted, in groups. `limits` are the
    cross-entropies beyond which texts are rejected."""

    groups: list[Group]
    limits: dict[str, float]

    @property
    def languages(self) -> list[str]:
        return [language for group in self.groups for language in group.languages]

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Summed over the text, for each language."""
        return np.concatenate([g.log_probability(codes) for g in self.groups] or [np.zeros(0)])

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, accepted)."""
        codes = encode(text or "")
        letters = int(np.count_nonzero(codes))
        if not letters or not self.groups:
            return UNKNOWN, 0.0, False
        entropy = -self.log_probability(codes) / len(codes)
        best = int(np.argmin(entropy))
        gaps = (entropy - entropy[best]) * min(len(codes), EVIDENCE)
        language = self.languages[best]
        far = letters >= MIN_LETTERS and entropy[best] > self.limits.get(language, np.inf)
        return language, float(1 / np.exp(-gaps).sum()), not far


def grouped(sizes: dict[str, int]) -> list[list[str]]:
    """Languages, sorted, in groups whose tables hold GROUP_NUMBERS at most, by
    the number of n-grams of each; a language beyond that is a group alone."""
    groups: list[list[str]] = []
    keys = 0
    for language in sorted(sizes):
        keys += sizes[language]
        if not groups or keys * (len(groups[-1]) + 1) > GROUP_NUMBERS:
            groups.append([])
            keys = sizes[language]
        groups[-1].append(language)
    return groups


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models from each language's (sorted keys, counts) of ORDER-grams."""
    groups = grouped({language: len(keys) for language, (keys, _) in counts.items()})
    seen = [np.unique(keys & _CHARACTER) for keys, _ in counts.values()]
    characters = len(np.unique(np.concatenate(seen))) if seen else 0
    return Models([_group({x: counts[x] for x in own}, characters) for own in groups], {})


def _group(counts: dict[str, tuple[np.ndarray, np.ndarray]], characters: int) -> Group:
    """Models of some languages, over the characters of all and one unknown."""
    languages = sorted(counts)
    tables: list[list] = [[] for _ in range(ORDER + 1)]
    for language in languages:
        keys, n = counts[language]
        for order in range(ORDER, 0, -1):
            tables[order].append((keys, n))
            # Shorter models count the distinct n-grams that go on to the left.
            keys, n = np.unique(
                keys & np.uint64((1 << 16 * (order - 1)) - 1), return_counts=True
            )
    empty = np.zeros(0, np.uint64)
    size = characters + 1
    models = Group(languages, [empty], [], [empty], [], -float(np.log(size)))
    models.log_p.append(np.zeros((0, len(languages)), np.float32))
    models.log_g.append(np.zeros((0, len(languages)), np.float32))
    lower = None
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([k for k, _ in tables[order]] or [empty]))
        contexts = np.unique(union >> _BITS)
        p = np.zeros((len(union), len(languages)))
        g = np.zeros((len(contexts), len(languages)))
        suffix = union & np.uint64((1 << 16 * (order - 1)) - 1)
        for i, (keys, n) in enumerate(tables[order]):
            ones, twos = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            own, first = np.unique(keys >> _BITS, return_index=True)
            sums = np.add.reduceat(n, first) if len(first) else n
            kinds = np.diff(np.r_[first, len(keys)])
            weight = discount * kinds / sums
            at, there = _find(own, contexts)
            g[:, i] = np.where(there, weight[at], 1.0)
            at, there = _find(keys, union)
            in_context, _ = _find(own, union >> _BITS)
            p[there, i] = (n[at[there]] - discount) / sums[in_context[there]]
            shorter = 1 / size if order == 1 else lower[_find(models.keys[-1], suffix)[0], i]
            p[:, i] += g[_find(contexts, union >> _BITS)[0], i] * shorter
        lower = p
        models.keys.append(union)
        models.contexts.append(contexts)
        models.log_p.append(np.log(p).astype(np.float32))
        models.log_g.append(np.log(g).astype(np.float32))
    return models


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_language: dict[str, list[np.ndarray]] = {}
        for language, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            by_language.setdefault(language, []).append(ngram_keys(encode(text or "")))
        for language, parts in by_language.items():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.record_batch(
                [pa.array([language] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)],
                ["lang", "key", "n"],
            )


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no model may learn from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame) -> Models:
    """Models from labelled documents that are not held out.

    About SAMPLE_DOCS documents of each language, those with the smallest
    hashes of their ids; rarer languages give all they have. Where a language
    has CALIBRATED_DOCS of them, each CALIBRATION-th is left out of the counts:
    the QUANTILE of their cross-entropies and a margin is the limit beyond which
    a text is rejected. Other languages take over the widest of these limits.

    More than MOST_LANGUAGES labels are an error. The counts of one group of
    models at a time come to the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    ).select("doc_id", "lang", "text")
    sizes = usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages are labelled")
    if not sizes:
        return build({})
    parts = 1 << 30
    shares = spark.createDataFrame(
        [
            (r["lang"], min(parts, parts * SAMPLE_DOCS // r["count"]), r["count"] >= CALIBRATED_DOCS)
            for r in sizes
        ],
        "lang string, share long, spares boolean",
    )
    mixed = F.xxhash64("doc_id", F.lit(3))
    calibrates = F.col("spares") & (F.pmod(F.shiftright(mixed, 31), F.lit(CALIBRATION)) == 0)
    folder = new_folder(spark, "language")
    sample = stored(  # what all further passes read
        usable.join(F.broadcast(shares), "lang")
        .where(F.pmod(mixed, F.lit(parts)) < F.col("share"))
        .select("lang", "text", calibrates.alias("calibrates")),
        f"{folder}/sample",
    )
    counts = stored(
        sample.where(~F.col("calibrates"))
        .select("lang", "text")
        .mapInArrow(_count, "lang string, key long, n long")
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n")),
        f"{folder}/counts",
    )
    groups = grouped({r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()})
    models = Models([], {})
    last = F.col("key").bitwiseAND(F.lit(int(_CHARACTER)))
    characters = counts.select(last).distinct().count()
    for group in groups:
        rows = counts.where(F.col("lang").isin(group)) if len(groups) > 1 else counts
        table = rows.toArrow()
        own = {}
        for language in group:
            mine = table.filter(pa.compute.equal(table["lang"], language))
            keys = mine["key"].to_numpy().view(np.uint64)
            order = np.argsort(keys)
            own[language] = keys[order], mine["n"].to_numpy()[order]
        models.groups.append(_group(own, characters))
    limits = (
        sample.where("calibrates")
        .select("lang", _entropies(models)("lang", "text").alias("e"))
        .groupBy("lang")
        .agg(F.percentile("e", F.lit(QUANTILE)).alias("e"))
        .collect()
    )
    removed(spark, folder)
    models.limits = {r["lang"]: r["e"] + MARGIN for r in limits if r["e"] is not None}
    widest = max(models.limits.values(), default=np.inf)
    models.limits = dict.fromkeys(models.languages, widest) | models.limits
    return models


def _entropies(models: Models):
    languages = frozenset(models.languages)

    @F.arrow_udf(T.DoubleType())
    def entropies(langs: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for lang, text in zip(langs.to_pylist(), texts, strict=True):
            codes = encode(text.as_py())
            if lang not in languages or np.count_nonzero(codes) < MIN_LETTERS:
                out.append(None)
                continue
            group = next(g for g in models.groups if lang in g.languages)
            total = group.log_probability(codes)[group.languages.index(lang)]
            out.append(-total / len(codes))
        return pa.array(out, pa.float64())

    return entropies


_RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)


def identified(text: str | Column, models: Models) -> Column:
    """Struct of lang_pred, score and accepted for a column of texts.

    Null texts and texts without a letter are UNKNOWN, with score 0, and not
    accepted. Ties go to the language that sorts first.
    """

    @F.arrow_udf(_RESULT)
    def identify(texts: pa.Array) -> pa.Array:
        rows = [models.classify(t.as_py()) for t in texts]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.string(), pa.float64(), pa.bool_())
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["lang_pred", "score", "accepted"],
        )

    return identify(F.col(text) if isinstance(text, str) else text)


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) for every row of `docs`.
    Without labelled documents every text is UNKNOWN."""
    found = identified("text", fit(docs))
    return docs.select("doc_id", held_out().alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score", "found.accepted"
    )


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language is found and not rejected, as they are."""
    return docs.where(identified("text", fit(docs))["accepted"])
