"""Language by character models with interpolated Kneser-Ney smoothing.

A word is a run of letters in lower case between two edges. For each language
the model gives the probability of a character after up to ``ORDER - 1``
others of its word: counts at the highest order, numbers of distinct
predecessors below, each less a discount that goes to the next lower order.

Some languages' models share one sorted array of n-gram hashes for each order,
with a row of log probabilities, one for each language; a second array holds the
weights with which a context falls back. So the arrays grow with the number of
languages, not with its square. A text's language is that of the lowest
cross-entropy for each character. A text that fits its language far worse than
texts of that language do is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hashed_sample

ORDER = 4
DISCOUNT = 0.75
UNKNOWN = "und"
HELD_OUT = 0
# The bounded sample of labelled rows the models are fitted on: so many documents
# of each language, by the hash of their id, and the first words of a document up
# to so many characters. All languages are learnt; many share the documents that
# so many languages have, down to the least number.
TRAINING_DOCS = 600
TRAINING_CHARS = 16_384
FULL_LANGUAGES = 16
LEAST_DOCS = 25
# Languages that share arrays.
TOGETHER = 8
# Rejected is what no more than this share of held-back training texts would be.
REJECTED_SHARE = 0.001
# For up to FULL_LANGUAGES; fewer the more languages there are.
KEPT_WORDS = 150_000
CHARS_TOGETHER = 500_000

LETTERS = re.compile(r"[^\W\d_]+")
EDGE = 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Documents nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == HELD_OUT, F.lit(False))


def grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the grams of each order that end at each character, and word starts.

    The characters of a word and its right edge are predicted; ``[k]`` is the
    gram of ``k`` characters that ends there, or a shorter one at the word's
    beginning, ``[0]`` that of none.
    """
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    text = np.frombuffer(("\x01" + "\x01".join(words) + "\x01").encode("utf-32-le"), dtype=np.uint32)
    codes = text.astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    # Place in the word: 1 for its first character; its right edge comes last.
    place = np.arange(len(codes) - 1) + 1 - np.repeat(starts, lengths + 1)
    last = np.arange(1, len(codes))
    made = [np.zeros(len(last), dtype=np.uint64)]
    for k in range(1, ORDER + 1):
        mixed = np.full(len(last), k, dtype=np.uint64)
        for back in range(k - 1, -1, -1):
            mixed = (mixed ^ codes[np.maximum(last - back, 0)]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        # No further back than the left edge.
        made.append(np.where(place >= k - 1, mixed, made[-1]))
    return made, starts


def contexts(words: list[str]) -> list[np.ndarray]:
    """Hashes of the grams before each predicted character, of 0 to ORDER - 1 characters."""
    made, _ = grams(words)
    starts = np.cumsum([0, *[len(w) + 1 for w in words]])[:-1]
    out = []
    for k in range(ORDER):
        before = np.empty_like(made[k])
        before[1:] = made[k][:-1]
        # At a word's first character the context is the left edge.
        before[starts] = _edge_hash() if k else 0
        out.append(before)
    return out


def _edge_hash() -> np.uint64:
    with np.errstate(over="ignore"):
        mixed = (np.uint64(1) ^ np.uint64(EDGE)) * _MIX
        return mixed ^ (mixed >> np.uint64(29))


@dataclass
class Arrays:
    """The models of a few languages, by order."""

    keys: list[np.ndarray]
    logs: list[np.ndarray]
    context_keys: list[np.ndarray] = field(default_factory=list)
    fallbacks: list[np.ndarray] = field(default_factory=list)


@dataclass
class Models:
    """The languages' models in arrays; see ``learn``."""

    languages: list[str]
    arrays: list[Arrays] = field(default_factory=list)
    floor: float = 0.0
    middle: np.ndarray | None = None
    spread: np.ndarray | None = None
    most: float = np.inf

    def log_probabilities(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word its log probability in each language, and its characters."""
        made, starts = grams(words)
        before = contexts(words)
        letters = np.array([any(c.isalpha() for c in w) for w in words])
        sums = np.concatenate([self._sums(some, made, before, starts) for some in self.arrays], axis=1)
        return np.where(letters[:, None], sums, 0), np.where(letters, [len(w) + 1 for w in words], 0)

    def _sums(self, some: Arrays, made: list, before: list, starts: np.ndarray) -> np.ndarray:
        n = len(made[0])
        total = np.zeros((n, some.logs[0].shape[1]), dtype=np.float32)
        rest = np.arange(n)
        for k in range(ORDER, 0, -1):
            at, found = _find(some.keys[k], made[k][rest])
            total[rest[found]] += some.logs[k][at[found]]
            rest = rest[~found]
            if not len(rest):
                break
            at, found = _find(some.context_keys[k - 1], before[k - 1][rest])
            total[rest[found]] += some.fallbacks[k - 1][at[found]]
        total[rest] += self.floor
        return np.add.reduceat(total, starts, axis=0)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def learn(words_by_language: dict[str, Counter]) -> Models:
    """Kneser-Ney models of words with their counts, one for each language."""
    models = Models(sorted(words_by_language))
    # All languages have one alphabet, or their probabilities could not be compared.
    alphabet = len(set().union(*(w for words in words_by_language.values() for w in words))) + 2
    models.floor = -np.log(alphabet)
    for at in range(0, len(models.languages), TOGETHER):
        tables = [_counts(words_by_language[name]) for name in models.languages[at : at + TOGETHER]]
        models.arrays.append(_arrays(tables, alphabet))
    return models


def _arrays(tables: list[list[tuple]], alphabet: int) -> Arrays:
    """The languages' counts as shared arrays of log probabilities."""
    size = len(tables)
    some = Arrays([np.empty(0, np.uint64)], [np.empty((0, size), np.float32)])
    lower: dict[int, np.ndarray] = {}
    for k in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([t[k][0] for t in tables]))
        context_keys = np.unique(np.concatenate([t[k][1] for t in tables]))
        own, fall = np.zeros((len(keys), size)), np.ones((len(context_keys), size))
        # Every gram of the shared array: its context and the gram one shorter.
        context_of, shorter = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
        for t in tables:
            at, _ = _find(keys, t[k][0])
            context_of[at], shorter[at] = t[k][1], t[k][2]
        for j, t in enumerate(tables):
            gram, context, _, count = t[k]
            sums_at, _ = _find(context_keys, context)
            sums = np.bincount(sums_at, weights=count, minlength=len(context_keys))
            kinds = np.bincount(sums_at, minlength=len(context_keys))
            seen = sums > 0
            fall[seen, j] = DISCOUNT * kinds[seen] / sums[seen]
            at, _ = _find(keys, gram)
            own[at, j] = (count - DISCOUNT) / sums[sums_at]
        if k == 1:
            below = np.full((len(keys), size), 1 / alphabet)
        else:
            at, _ = _find(some.keys[k - 1], shorter)
            below = lower[k - 1][at]
        context_at, _ = _find(context_keys, context_of)
        lower[k] = own + fall[context_at] * below
        some.keys.append(keys)
        some.logs.append(np.log(lower[k]).astype(np.float32))
        some.context_keys.append(context_keys)
        some.fallbacks.append(np.log(fall).astype(np.float32))
    return some


def _counts(words: Counter) -> list[tuple]:
    """For each order: grams, their contexts, the grams one shorter, and counts.

    At the highest order, and where a gram begins at a word's edge, how often it
    occurs; else how many different characters stand before it.
    """
    listed = list(words)
    times = np.repeat(np.array([words[w] for w in listed], dtype=np.int64), [len(w) + 1 for w in listed])
    made, _ = grams(listed)
    before = contexts(listed)
    place = np.concatenate([np.arange(1, len(w) + 2) for w in listed])
    out: list[tuple] = [()]
    for k in range(1, ORDER + 1):
        real = place >= k - 1
        gram, first, back = np.unique(made[k][real], return_index=True, return_inverse=True)
        context, shorter = before[k - 1][real][first], made[k - 1][real][first]
        occurs = np.bincount(back, weights=times[real], minlength=len(gram))
        if k < ORDER:
            longer = place >= k
            pairs = np.unique(np.column_stack([made[k][longer], made[k + 1][longer]]), axis=0)
            at, found = _find(gram, pairs[:, 0])
            kinds = np.bincount(at[found], minlength=len(gram))
            occurs = np.where(kinds > 0, kinds, occurs)
        out.append((gram, context, shorter, occurs))
    return out


class Reader:
    """Applies models to texts, each word once; words kept are limited in number."""

    def __init__(self, models: Models):
        self.models = models
        self.places: dict[str, int] = {}
        self.sums = np.empty((0, len(models.languages)), np.float32)
        self.lengths = np.empty(0, np.int64)
        self.share = FULL_LANGUAGES / max(FULL_LANGUAGES, len(models.languages))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the cross-entropy in each language, and its characters."""
        parts, start, size = [], 0, 0
        for at, text in enumerate(texts, 1):
            size += len(text or "")
            if size > CHARS_TOGETHER * self.share or at == len(texts):
                parts.append(self._some(texts[start:at]))
                start, size = at, 0
        if not parts:
            return np.empty((0, len(self.models.languages))), np.empty(0)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _some(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        words = [LETTERS.findall((t or "").lower()) for t in texts]
        if len(self.places) > KEPT_WORDS * self.share:
            self.__init__(self.models)
        unseen = list(set().union(*words).difference(self.places))
        if unseen:
            sums, lengths = self.models.log_probabilities(unseen)
            self.places.update(zip(unseen, range(len(self.places), len(self.places) + len(unseen)), strict=True))
            self.sums, self.lengths = np.concatenate([self.sums, sums]), np.concatenate([self.lengths, lengths])
        total = np.zeros((len(texts), len(self.models.languages)))
        length = np.zeros(len(texts))
        for k, own in enumerate(words):
            at = np.fromiter(map(self.places.__getitem__, own), np.int64, len(own))
            total[k], length[k] = self.sums[at].sum(axis=0, dtype=np.float64), self.lengths[at].sum()
        return -total / np.maximum(length, 1)[:, None], length

    def classify(self, texts: list[str | None]) -> pd.DataFrame:
        """``lang_pred``, ``score`` and ``rejected`` of each text."""
        n = len(texts)
        if not n or not self.models.languages:
            blank = {"lang_pred": np.full(n, UNKNOWN, object), "score": np.zeros(n), "rejected": np.ones(n, bool)}
            return pd.DataFrame(blank)
        entropies, length = self.entropies(texts)
        known = length > 0
        best = entropies.argmin(axis=1)
        names = np.array([*self.models.languages, UNKNOWN], dtype=object)
        # The share of the best language's probability, for a text of this many characters.
        ahead = np.exp(-(entropies - entropies.min(axis=1, keepdims=True)) * np.minimum(length, 100)[:, None])
        misfit = self.misfit(entropies, length, best)
        score = np.where(known, 1 / ahead.sum(axis=1) / (1 + np.exp(misfit - 2 * self.limit())), 0)
        rejected = ~known | (misfit > self.limit())
        return pd.DataFrame({"lang_pred": names[np.where(known, best, -1)], "score": score, "rejected": rejected})

    def limit(self) -> float:
        return self.models.most if np.isfinite(self.models.most) else 50.0

    def misfit(self, entropies: np.ndarray, length: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Standard deviations by which a text fits worse than its language's texts do."""
        if self.models.middle is None:
            return np.zeros(len(best))
        own = entropies[np.arange(len(best)), best]
        spread = self.models.spread[best] * (1 + 10 / np.sqrt(np.maximum(length, 1)))
        return (own - self.models.middle[best]) / spread


def calibrate(models: Models, texts_by_language: dict[str, list[str]]) -> Models:
    """Sets what is normal for a language from texts that the models have not seen."""
    reader, size = Reader(models), len(models.languages)
    middle, spread = np.zeros(size), np.ones(size)
    for j, name in enumerate(models.languages):
        entropies, length = reader.entropies(texts_by_language.get(name, []))
        own = entropies[length > 0, j]
        if len(own):
            middle[j] = np.median(own)
            spread[j] = max(0.02, 1.5 * np.median(np.abs(own - middle[j])))
    models.middle, models.spread = middle, spread
    misfits = []
    for j, name in enumerate(models.languages):
        entropies, length = reader.entropies(texts_by_language.get(name, []))
        of = np.full(len(length), j)
        misfits.append(reader.misfit(entropies, length, of)[length > 0])
    together = np.concatenate(misfits) if misfits else np.empty(0)
    if len(together):
        # Twice the limit that rejects hardly any of them, at least 8 deviations.
        models.most = float(max(8.0, 2 * np.quantile(together, 1 - REJECTED_SHARE)))
    return models


def train(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Models:
    """Models from a bounded sample of the documents that are not held out.

    Rows without id, language or a letter teach nothing, and every language of
    the others is learnt. Four fifths of the sample make the models, one fifth
    says what texts of a language look like.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
    ).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    counts = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    n = docs_of_each(len(counts))
    # At most n ids of each language; what comes back is their first words.
    chosen = hashed_sample(rows.select("doc_id", "lang"), "lang", counts, n).distinct()
    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select(
        "doc_id", "lang", first_words(F.col("text")).alias("text")
    )
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "doc_id", "text").toLocalIterator():
        texts.setdefault(row["lang"], []).append(row["text"])
    return fit(texts)


def docs_of_each(languages: int) -> int:
    """How many documents of each of so many languages the models are fitted on."""
    return min(TRAINING_DOCS, max(LEAST_DOCS, TRAINING_DOCS * FULL_LANGUAGES // max(1, languages)))


def first_words(text: Column) -> Column:
    """The text, of a longer one the first letters and what is between them.

    What is no letter is one space then, so a text that begins with tables still
    teaches; a word that does not end is left out unless it is the only one.
    """
    letters = F.trim(F.regexp_replace(text, r"[^\p{L}\p{Nl}\p{No}]+", " "))
    first = F.substring(letters, 1, TRAINING_CHARS)
    whole = F.when(F.length(letters) > TRAINING_CHARS, F.regexp_replace(first, r" [^ ]*$", "")).otherwise(first)
    return F.when(F.length(text) <= TRAINING_CHARS, text).otherwise(whole)


def fit(texts: dict[str, list[str]]) -> Models:
    """Models and their limits from texts of each language."""
    counted, rest = {}, {}
    for name, own in texts.items():
        kept_back = own[::5] if len(own) >= 5 else []
        words: Counter = Counter()
        for text in own if not kept_back else [t for k, t in enumerate(own) if k % 5]:
            words.update(LETTERS.findall(text.lower()))
        if words:
            counted[name], rest[name] = words, kept_back or own
    if not counted:
        return Models([])
    return calibrate(learn(counted), rest)


RESULT = "lang_pred string, score double, rejected boolean"


def identify(text: Column, models: Models) -> Column:
    """Struct of language, score and whether the whole text is rejected."""

    @F.pandas_udf(RESULT)
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(models)
        for batch in batches:
            yield reader.classify(batch.tolist())

    return of_texts(text)


def classify(docs: DataFrame, models: Models, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row.

    NULL texts and texts without a letter are ``und`` with the score 0 and are
    rejected; so is everything if nothing was learnt. A NULL id is not held
    out; repeated rows are rows like others; an empty table gives no rows.
    """
    doc_id = F.col(f"`{id_col}`")
    return docs.select(
        doc_id.cast("long").alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        identify(F.col(f"`{text_col}`"), models).alias("found"),
    ).select("doc_id", "held_out", "found.*")
