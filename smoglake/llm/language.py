"""Language identification: known words first, then ever shorter character n-grams.

The model holds, per language, the log frequency of every word seen at least
twice in the training sample, and of character n-grams of one to
``ORDER`` letters counted over all words (with word edges marked). A word of
a text that the model knows adds its log frequencies. For an unseen word,
each place adds those of the longest n-gram ending there that the model
knows. The language with the greatest sum wins; the score is its share after
normalising the sums, flattened by the root of the number of words.

Training rows: hash-chosen documents outside the held-out fifth, at most about
``SAMPLE_DOCS``. The model is bounded by ``MAX_WORDS`` and ``MAX_GRAMS``
entries (the most frequent ones) and reaches the workers as a broadcast of
that bounded size.

Defined results: ``und`` with score 0 for a null text or one without a letter
(and for every text if there is nothing to learn from); repeated rows are
scored row by row; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import DOUBLE, LONG, STRING, field, hash_sample, id_remainder, load_documents, map_columns, staged

SAMPLE_DOCS = 20_000
MAX_WORDS = 200_000
MAX_GRAMS = 100_000
ORDER = 4
HELD_OUT = 5

LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def grams(word: str, order: int = ORDER) -> list[str]:
    """All n-grams of one to ``order`` characters of the word with marked edges."""
    edged = f"^{word}$"
    return [edged[i:i + n] for n in range(1, order + 1) for i in range(len(edged) - n + 1)]


class Model:
    """Log frequencies by language: ``words`` and ``grams`` map to rows of ``table``."""

    def __init__(self, langs: list[str], word_rows: list[tuple[str, str, int]], gram_rows: list[tuple[str, str, int]],
                 prior: dict[str, int]):
        self.langs = langs
        place = {x: i for i, x in enumerate(langs)}
        self.word_logs, self.words = _logs(word_rows, place)
        self.gram_logs, self.grams = _logs(gram_rows, place)
        self.prior = np.log(np.array([prior[x] for x in langs], float) / sum(prior.values()))
        self.unseen: dict[str, np.ndarray] = {}

    def backoff(self, word: str) -> np.ndarray:
        """Sum over the word's places of the log frequencies of the longest known n-gram that ends there."""
        if (kept := self.unseen.get(word)) is not None:
            return kept
        edged, total = f"^{word}$", np.zeros(len(self.langs))
        for end in range(2, len(edged) + 1):
            for n in range(min(ORDER, end), 0, -1):
                at = self.grams.get(edged[end - n:end])
                if at is not None:
                    total += self.gram_logs[at]
                    break
        total /= max(1, len(edged) - 1)
        if len(self.unseen) > 100_000:
            self.unseen.clear()
        self.unseen[word] = total
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        found = letter_words(text)
        if not self.langs or not any(c.isalpha() for w in found for c in w):
            return "und", 0.0
        total, known = self.prior.copy(), []
        for word, n in Counter(found).items():
            at = self.words.get(word)
            if at is None:
                total += n * self.backoff(word)
            else:
                known.append((at, n))
        if known:
            rows, times = np.array(known).T
            total += times @ self.word_logs[rows]
        best = int(total.argmax())
        flat = (total - total[best]) / math.sqrt(len(found))
        return self.langs[best], float(1.0 / np.exp(flat).sum())


def _logs(rows: list[tuple[str, str, int]], place: dict[str, int]) -> tuple[np.ndarray, dict[str, int]]:
    """Smoothed log frequencies per language of each entry, and the entries' rows."""
    entries: dict[str, int] = {}
    for _, entry, _ in rows:
        entries.setdefault(entry, len(entries))
    counts = np.zeros((len(entries), len(place)))
    for lang, entry, n in rows:
        counts[entries[entry], place[lang]] = n
    totals = counts.sum(0)
    return np.log((counts + 0.5) / (totals + 0.5 * max(1, len(entries)))), entries


def learn(rows: DataFrame) -> Model:
    """The model from rows of (text, lang), lang not null. Counting is distributed; the model is bounded."""
    def count_words(texts):
        made = [Counter(letter_words(t)) for t in texts]
        return [[[{"entry": w, "n": n} for w, n in c.items()] for c in made]]

    entry = T.ArrayType(T.StructType([field("entry", STRING), field("n", LONG)]))
    words = map_columns(rows, ["text"], [field("words", entry)], count_words, ["lang"])
    words = staged(words.select("lang", F.explode("words").alias("w")).groupBy("lang", F.col("w.entry").alias("entry"))
                   .agg(F.sum("w.n").alias("n")), "language-words")

    def count_grams(entries):
        return [[grams(w) for w in entries]]

    parts = map_columns(words, ["entry"], [field("grams", T.ArrayType(STRING))], count_grams, ["lang", "n"])
    pieces = parts.select("lang", "n", F.explode("grams").alias("entry")).groupBy("lang", "entry").agg(F.sum("n").alias("n"))

    def most(table, limit, least):
        total = table.groupBy("entry").agg(F.sum("n").alias("all")).filter(F.col("all") >= least)
        top = total.orderBy(F.desc("all"), "entry").limit(limit)
        return [(r["lang"], r["entry"], r["n"]) for r in table.join(top, "entry").select("lang", "entry", "n").collect()]

    prior = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    return Model(sorted(prior), sorted(most(words, MAX_WORDS, 2)), sorted(most(pieces, MAX_GRAMS, 2)), prior)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             held_out: int = HELD_OUT, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(id, held_out, lang_pred, score) per row. One map over the texts with the broadcast model."""
    train = docs.filter((id_remainder(id_col, held_out) != 0) & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    sample = staged(hash_sample(train, "id", sample_docs).select("text", "lang"), "language-sample")
    model = docs.sparkSession.sparkContext.broadcast(learn(sample))

    def run(texts):
        rows = [model.value.predict(t) for t in texts]
        return [[r[0] for r in rows], [r[1] for r in rows]]

    keyed = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text_"),
                        (id_remainder(id_col, held_out) == 0).alias("held_out"))
    return map_columns(keyed, ["text_"], [field("lang_pred", STRING), field("score", DOUBLE)], run, [id_col, "held_out"])


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify(load_documents(spark, sf_dir))
