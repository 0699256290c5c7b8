"""Language identification, words first.

A known word scores by its log frequency in each language. An unseen word falls back to its character n-grams of
length 5, then 4, and so on down to single characters: the first length with a known n-gram decides. The model is
counted by Spark on a bounded sample of the labelled documents of each language. A word or n-gram belongs to the model if
it makes up at least a stated share of the words or n-grams of one language, so no language is crowded out by a larger
one, the same rule holds at every size, and the share bounds the model: 1 / share entries of each language at most.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import add_columns
from tradelake.session import materialize

# Of each language.
SAMPLE_DOCS = 20_000
# A word or n-gram is known if one of so many in a language is it.
RAREST = 200_000
LONGEST = 5
# Longer words are known by a hash; their n-grams are counted in stretches of so many.
LONG_WORD = 64
SMOOTH = 0.1
# Chunks between spaces whose scores a task remembers.
CACHE = 200_000
# Words that count fully towards the score; more words do not make it surer.
SURE_WORDS = 20
# A letter and the letters and marks (vowel signs, for instance) that follow it.
_WORD = r"\p{L}[\p{L}\p{M}]*"
_WORDS = regex.compile(_WORD)


def held_out(doc_id):
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, rarest: int = RAREST) -> dict:
    """Log frequencies of words and n-grams per language, from about `sample_docs` labelled documents of each.

    Learns from text and lang of rows that are not held out and have a lang; a language with `sample_docs` such rows or
    fewer is read whole. The sample is drawn by a hash of the id. Words are a letter and the letters and marks after it,
    in lower case. A word (n-gram) that one in `rarest` words (n-grams) of some language is, or more, is kept with its
    counts in all languages; where a language has no more than `rarest` of them, that is every one. Languages without
    documents in the table are unknown.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    totals = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    empty = {"langs": [], "words": [], "word_logs": np.zeros((0, 0)), "grams": [], "gram_logs": np.zeros((0, 0))}
    if not totals:
        return empty
    shares = F.create_map(*map(F.lit, chain(*[(x, int((1 << 30) * min(1.0, sample_docs / n))) for x, n in totals.items()])))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < shares[F.col("lang")]
    words = labelled.where(part).select(
        "lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({_WORD})"))).alias("word")
    )
    counts = materialize(words.groupBy("word", "lang").count(), "word-counts")
    sizes = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("count").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return empty
    padded = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    # A stretch has the n-grams that start in its first LONG_WORD characters.
    starts = F.sequence(F.lit(1), F.length(padded), F.lit(LONG_WORD))
    stretches = counts.select(
        "lang", "count", F.explode(F.transform(starts, lambda i: F.substring(padded, i, F.lit(LONG_WORD + LONGEST - 1)))).alias("part")
    )
    size = F.length("part")

    def grams_of(n: int):
        # The function has one parameter only: Spark would give a second one the index.
        places = F.sequence(F.lit(1), F.greatest(F.least(size - n + 1, F.lit(LONG_WORD)), F.lit(1)))
        found = F.transform(places, lambda i: F.substring("part", i, F.lit(n)))
        return F.when(size >= n, found).otherwise(F.expr("cast(array() as array<string>)"))

    grams = stretches.select(
        "lang",
        "count",
        F.explode(F.flatten(F.array(*[grams_of(n) for n in range(1, LONGEST + 1)]))).alias("gram"),
    )
    gram_counts = materialize(grams.groupBy("gram", "lang").agg(F.sum("count").alias("count")), "gram-counts")

    def known(table: DataFrame, key: str) -> tuple[list[str], np.ndarray]:
        per_lang = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("count"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(langs)]
        totals = {r[0]: r[1] for r in table.groupBy("lang").agg(F.sum("count")).collect()}
        often = F.greatest(*[F.col(f"n{i}") * rarest >= totals.get(x, 0) for i, x in enumerate(langs)], F.lit(False))
        found = sorted(table.groupBy(key).agg(*per_lang).where(often).collect())
        seen = np.array([r[1:] for r in found], float).reshape(len(found), len(langs))
        return [r[0] for r in found], np.log((seen + SMOOTH) / (seen.sum(0) + SMOOTH * len(found)))

    long = F.concat(F.lit("#"), F.sha2(F.encode("word", "UTF-8"), 256))
    counts = counts.withColumn("word", F.when(F.length("word") > LONG_WORD, long).otherwise(F.col("word")))
    word_keys, word_logs = known(counts, "word")
    gram_keys, gram_logs = known(gram_counts, "gram")
    return {"langs": langs, "words": word_keys, "word_logs": word_logs, "grams": gram_keys, "gram_logs": gram_logs}


class Scorer:
    """Scores texts with a fitted model, which it keeps as two dictionaries of places and one array of numbers."""

    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.words = dict(zip(model["words"], range(len(model["words"])), strict=True))
        self.grams = dict(zip(model["grams"], range(len(self.words), len(self.words) + len(model["grams"])), strict=True))
        self.logs = array("d", np.concatenate([model["word_logs"], model["gram_logs"]]).tobytes())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.langs) + 1))

    def _logs(self, place: int) -> array:
        return self.logs[place * len(self.langs) : (place + 1) * len(self.langs)]

    def word(self, word: str) -> array | tuple[float, ...]:
        place = self.words.get(word if len(word) <= LONG_WORD else "#" + hashlib.sha256(word.encode()).hexdigest())
        if place is not None:
            return self._logs(place)
        padded, grams = f"<{word}>", self.grams
        for n in range(min(LONGEST, len(padded)), 0, -1):
            found = [self._logs(grams[g]) for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in grams]
            if found:
                return tuple([sum(x) / len(found) for x in zip(*found, strict=True)])
        return (0.0,) * len(self.langs)

    def row(self, chunk: str) -> int:
        """Where the sum over the words of a chunk between spaces is kept, with their number in the last place."""
        at = len(self.known)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.known[chunk] = at
        words = _WORDS.findall(chunk.lower())
        if len(words) == 1:
            self.rows[at] = (*self.word(words[0]), 1)
        elif words:
            self.rows[at] = (*map(sum, zip(*map(self.word, words), strict=True)), len(words))
        return at

    def text(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether there is a letter; `und` and 0 if there is none or nothing was learned."""
        if len(self.known) > CACHE:
            self.forget()
        known, chunks = self.known, (text or "").split()
        at = [known[c] if c in known else self.row(c) for c in chunks]
        sums = self.rows[at].sum(0) if at else np.zeros(len(self.langs) + 1)
        letters = bool(sums[-1])
        if not letters or not self.langs:
            return "und", 0.0, letters
        logs = sums[:-1] / sums[-1] * min(sums[-1], SURE_WORDS)
        odds = np.exp(logs - logs.max())
        best = int(odds.argmax())
        return self.langs[best], float(odds[best] / odds.sum()), letters


def predict(docs: DataFrame, model: dict) -> tuple[DataFrame, str]:
    """All rows of `docs` with one more struct column (lang_pred, score, has_letters), and its name. Looks at `text` only.

    `und` is also what a model without languages says, and may be a learned label: only has_letters tells texts without
    a letter. Equal scores go to the language first in order of name. A repeated row gets the same result again.

    The model is broadcast: it has a bounded number of entries, and each Python worker keeps it once, until it gets a task
    of another stage.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(model))

    def compute(batch: list[str | None]) -> list:
        return list(zip(*map(shared.value.text, batch), strict=True))

    def finish() -> None:
        shared.value.forget()

    return add_columns(docs, compute, "lang_pred string, score double, has_letters boolean", finish)
