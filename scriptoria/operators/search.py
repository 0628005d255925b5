"""Full-text search: tokens with positions and weights, and the syntax of queries (``postings`` has the written index that queries read).

Positions count stop words, and fields are laid one after another.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptoria.functions.stemming import stem

# Weights of the classes A to D.
WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}
OTHER = r"[^\p{L}\p{N}_]+"


@dataclass(frozen=True)
class Config:
    """How words become terms; one object serves the token table and its queries."""

    stemmed: bool = False
    stop: tuple[str, ...] = ()

    @staticmethod
    def russian(spark) -> Config:
        """Stems, without the stop words of Russian and (for Latin words) English."""
        return Config(True, tuple(russian_stop_words(spark)) + tuple(english_stop_words(spark)))

    def term(self, word: str) -> str | None:
        """Term of a query's word, None for a stop word."""
        w = word.lower()
        return None if w in self.stop else stem(w) if self.stemmed else w


PLAIN = Config()


def tokens(text: Column) -> Column:
    """Lower-case words in order."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), OTHER), lambda w: w != "")


@F.pandas_udf(T.ArrayType(T.StringType()))
def stems(words: pd.Series) -> pd.Series:
    """Russian stems of Cyrillic words, English stems of Latin ones (cached by word within a batch)."""
    known: dict[str, str] = {}
    return words.map(lambda ws: None if ws is None else [None if w is None else known.get(w) or known.setdefault(w, stem(w)) for w in ws])


def _placed(terms: Column, offset: Column, weight: str) -> Column:
    return F.transform(terms, lambda t, k: F.struct(t.alias("term"), (k + 1 + offset).alias("pos"), F.lit(weight).alias("weight")))


def token_table(docs: DataFrame, key: list[str], fields: list[tuple[str, str]], config: Config = PLAIN) -> DataFrame:
    """(key, term, pos, weight) of all fields, given as (column, weight class) in the order of their positions."""
    prepared = docs.select(*key, *[tokens(F.col(c)).alias(f"_f{i}") for i, (c, _) in enumerate(fields)])
    offset = F.lit(0)
    parts = []
    for i, (_, weight) in enumerate(fields):
        words = F.col(f"_f{i}")
        if config.stop:  # stop words keep their positions, and have no term
            words = F.transform(words, lambda w: F.when(~w.isin(*config.stop), w))
        prepared = prepared.withColumn(f"_s{i}", stems(words) if config.stemmed else words)
        parts.append(_placed(F.col(f"_s{i}"), offset, weight))
        offset = offset + F.size(f"_f{i}")
    flat = prepared.select(*key, F.explode(F.concat(*parts)).alias("t")).select(*key, "t.term", "t.pos", "t.weight")
    return flat.where("term is not null") if config.stop else flat


def russian_stop_words(spark) -> list[str]:
    """The stop words that Spark itself ships for Russian."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("russian"))


def english_stop_words(spark) -> list[str]:
    """The stop words that Spark itself ships for English."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("english"))


@dataclass(frozen=True)
class Clause:
    """A word or phrase, perhaps negated."""

    words: tuple[str, ...]
    negated: bool = False


def parse(query: str) -> list[list[Clause]]:
    """Web-search syntax as alternatives (joined by ``or``) of clauses that must all hold; it never fails."""
    alternatives: list[list[Clause]] = [[]]
    for sign, phrase, word in re.findall(r'(-?)(?:"([^"]*)"?|([^\s"]+))', query):
        if word.lower() == "or" and not sign:
            if alternatives[-1]:
                alternatives.append([])
            continue
        words = tuple(re.findall(r"\w+", (phrase or word).lower()))
        if words:
            alternatives[-1].append(Clause(words, bool(sign)))
    return [a for a in alternatives if a]


def _terms(clause: Clause, config: Config) -> list[tuple[int, str]]:
    """(place, term) of a clause's words; stop words keep their place and have no term."""
    return [(i, t) for i, w in enumerate(clause.words) if (t := config.term(w)) is not None]


def scores(table: DataFrame, key: list[str], query: str, config: Config = PLAIN) -> DataFrame:
    """Weighted count of the query's terms in each document (order only; it never decides what matches)."""
    words = sorted({t for a in parse(query) for c in a if not c.negated for _, t in _terms(c, config)})
    weight = F.create_map(*[F.lit(x) for p in WEIGHTS.items() for x in p])[F.col("weight")]
    return table.where(F.col("term").isin(*words)).groupBy(*key).agg(F.sum(weight).alias("score"))
