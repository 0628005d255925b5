"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte context tree (contexts of up to ``order`` bytes) with escape
probabilities after method C: in a context seen n times with d distinct successors, a successor seen c times
has probability c / (n + d) and the escape to the next shorter context d / (n + d); below the empty context
every byte has probability 1/256.  Statistics are frozen after training, so the exact code length of a byte
depends on the ``order`` bytes before it alone, and is tabulated for every gram that training met in any
language; an unmet gram pays the escapes of its contexts, longest first.  A text's language is the one with
the shortest code for the whole text.

The classifier is fitted on a bounded sample of labelled rows: about ``rows_per_language`` rows of each language and
``max_rows`` in all, of about ``max_bytes`` of text (shared evenly by the languages), but one row at least of each, taken by a hash of the id: so
the model's size, which follows its text, is bounded too.  Every gram of these rows counts.  Scoring reads every whole text.

A code length is a sum over the grams that end at a byte.  With few languages it is tabulated for every gram and language
(``PpmModel``); where that table would have more than ``DENSE_CELLS`` cells, the same sum is taken over the pairs of gram and
language that training met (``SparsePpm``).

Defined results: null text, a text without a letter, or no training rows at all: ``und`` with score 0 and no
code length; ties go to the alphabetically first language; rows with a null label are scored like all others.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import text_chunks
from .common import BROADCAST_IDS, materialise, read_table

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def _gram_codes(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The gram of each byte: itself and the ``order`` bytes before it (0 before a document's start)."""
    lengths = np.diff(offsets)
    at = np.arange(len(data)) + order * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    padded = np.zeros(len(data) + order * len(lengths), np.uint64)
    padded[at] = data
    codes = padded.copy()
    for k in range(1, order + 1):
        codes[k:] |= padded[:-k] << np.uint64(8 * k)
    return codes[at]


class GramTable:
    """Look-up of 64-bit codes through a direct-address table on their hash."""

    def __init__(self, codes: np.ndarray):
        self.bits = max(4, int(len(codes)).bit_length() + 1)
        h = self._hash(codes)
        self.order = np.argsort(h, kind="stable")
        self.keys = codes[self.order]
        self.start = np.searchsorted(h[self.order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def _hash(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Index into ``keys`` of each code, -1 if absent."""
        out = np.full(len(codes), -1, np.int64)
        if not len(self.keys):
            return out
        h = self._hash(codes)
        at, end = self.start[h].astype(np.int64), self.start[h + 1]
        todo = np.flatnonzero(at < end)
        at, end, want = at[todo], end[todo], codes[todo]
        while len(todo):
            hit = self.keys[at] == want
            out[todo[hit]] = at[hit]
            at += 1
            go = ~hit & (at < end)
            todo, at, end, want = todo[go], at[go], end[go], want[go]
        return out


class PpmModel:
    """Tabulated code lengths (bits) of all grams for all languages."""

    def __init__(self, languages: list[str], language: np.ndarray, grams: np.ndarray, counts: np.ndarray, order: int):
        self.languages, self.order = languages, order
        k = len(languages)
        #: by gram length: table of grams met, their costs, and the escape costs of grams as contexts
        self.tables: dict[int, tuple[GramTable, np.ndarray]] = {}
        self.escapes: dict[int, tuple[GramTable, np.ndarray]] = {}
        below_cost = np.full((1, k), 8.0)
        below_table: GramTable | None = None
        self.root_escape = np.zeros(k)
        for m in range(1, order + 2):
            mask = np.uint64((1 << (8 * m)) - 1)
            codes = np.unique(grams & mask)
            table = GramTable(codes)
            keys = table.keys
            count = np.zeros((len(keys), k))
            np.add.at(count, (table.find(grams & mask), language), counts)
            context, index = np.unique(keys >> np.uint64(8), return_inverse=True)
            n = np.zeros((len(context), k))
            d = np.zeros((len(context), k))
            np.add.at(n, index, count)
            np.add.at(d, index, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                own = -np.log2(count / (n + d)[index])
                escape = np.where(n > 0, -np.log2(d / (n + d)), 0.0)
            lower = below_cost[0] if below_table is None else below_cost[below_table.find(keys & np.uint64((1 << (8 * (m - 1))) - 1))]
            cost = np.where(count > 0, own, escape[index] + lower)
            if m == 1:
                self.root_escape = escape[0] if len(escape) else np.zeros(k)
            else:
                at = GramTable(context)
                self.escapes[m - 1] = (at, np.vstack([escape[at.order], np.zeros((1, k))]).astype(np.float32))
            self.tables[m] = (table, cost.astype(np.float32))
            below_table, below_cost = table, cost

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each document in each language."""
        k = len(self.languages)
        total = np.zeros((len(offsets) - 1, k))
        if not len(data):
            return total
        codes = _gram_codes(data, offsets, self.order)
        cost = np.zeros((len(codes), k), np.float32)
        todo = np.arange(len(codes))
        for m in range(self.order + 1, 0, -1):
            table, costs = self.tables[m]
            mask = np.uint64((1 << (8 * m)) - 1)
            own = codes[todo] & mask
            row = table.find(own)
            hit = row >= 0
            cost[todo[hit]] += costs[row[hit]]
            todo, own = todo[~hit], own[~hit]
            if not len(todo):
                break
            if m > 1:
                at, escape = self.escapes[m - 1]
                cost[todo] += escape[at.find(own >> np.uint64(8))]  # the last row is for contexts not met
            else:
                cost[todo] += (self.root_escape + 8.0).astype(np.float32)
        filled = np.flatnonzero(np.diff(offsets))
        total[filled] = np.add.reduceat(cost, offsets[:-1][filled], axis=0, dtype=np.float64)
        return total


class SparsePpm:
    """The same code lengths from the pairs of gram and language that training met: memory follows the training rows alone.

    With own(g), the cost of a gram met, and esc(c), the escape of a context met, the bits of a byte are 8 plus, for each gram g
    that ends at it, esc(context of g) where the context was met and own(g) - esc(context of g) - own(shorter g) where g was.
    """

    def __init__(self, languages: list[str], language: np.ndarray, grams: np.ndarray, counts: np.ndarray, order: int):
        self.languages, self.order = languages, order
        bits, low = np.uint64(24), np.uint64((1 << 24) - 1)
        language = language.astype(np.uint64)
        below_keys, below_own = None, None
        #: by gram length: (table, edges, language, bits) of grams and of their contexts
        self.levels: dict[int, tuple] = {}
        for m in range(1, order + 2):
            keys, index = np.unique(((grams & np.uint64((1 << (8 * m)) - 1)) << bits) | language, return_inverse=True)
            count = np.bincount(index, counts, len(keys))
            code, lang = keys >> bits, keys & low
            ckeys, cindex = np.unique(((code >> np.uint64(8)) << bits) | lang, return_inverse=True)
            n, d = np.bincount(cindex, count, len(ckeys)), np.bincount(cindex, minlength=len(ckeys))
            own, escape = -np.log2(count / (n + d)[cindex]), -np.log2(d / (n + d))
            if m == 1:
                shorter = np.full(len(keys), 8.0)
            else:
                shorter = below_own[np.searchsorted(below_keys, ((code & np.uint64((1 << (8 * (m - 1))) - 1)) << bits) | lang)]
            self.levels[m] = (self._rows(code, lang, own - escape[cindex] - shorter), self._rows(ckeys >> bits, ckeys & low, escape))
            below_keys, below_own = keys, own

    @staticmethod
    def _rows(code: np.ndarray, lang: np.ndarray, bits: np.ndarray) -> tuple:
        """Look-up of sorted codes; a code's entries are edges[i] to edges[i + 1]."""
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
        table = GramTable(code[first])
        start, end = first[table.order], np.append(first[1:], len(code))[table.order] if len(code) else first
        return table, start, end, lang.astype(np.int64), bits

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each document in each language."""
        k = len(self.languages)
        total = np.repeat((8.0 * np.diff(offsets))[:, None], k, axis=1)
        if not len(data):
            return total
        codes = _gram_codes(data, offsets, self.order)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for m, parts in self.levels.items():
            own = codes & np.uint64((1 << (8 * m)) - 1)
            for (table, start, end, lang, bits), wanted in zip(parts, (own, own >> np.uint64(8)), strict=True):
                row = table.find(wanted)
                at = np.flatnonzero(row >= 0)
                lo, n = start[row[at]], (end - start)[row[at]]
                entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                total += np.bincount(np.repeat(doc[at], n) * k + lang[entry], bits[entry], total.size).reshape(total.shape)
        return total


#: Cells (grams times languages) up to which code lengths are tabulated (256 MB).
DENSE_CELLS = 32_000_000


def made_model(languages: list[str], language: np.ndarray, grams: np.ndarray, counts: np.ndarray, order: int) -> PpmModel | SparsePpm:
    kind = PpmModel if len(np.unique(grams)) * len(languages) <= DENSE_CELLS else SparsePpm
    return kind(languages, language, grams, counts, order)


#: Bytes of text that a model is fitted on, about.
MAX_BYTES = 64 << 20


def training_rows(docs: DataFrame, learn: Column, rows_per_language: int, max_rows: int, id_col: str = "doc_id", max_bytes: int = MAX_BYTES) -> DataFrame:
    """About ``rows_per_language`` labelled rows of each language, ``max_rows`` and ``max_bytes`` of text in all, one row at least of each; by a hash of the id."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30))
    sizes = materialise(labelled.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("n"), F.min(hashed).alias("least"), F.sum(F.octet_length("text").cast("long")).alias("bytes")), "languages")
    known = sizes.count()
    each = min(rows_per_language, max(1, max_rows // max(known, 1)))
    sizes = F.broadcast(sizes) if known <= BROADCAST_IDS else sizes
    rows = labelled.select(hashed.alias("h"), "text", "lang").join(sizes, F.col("lang") == F.col("l"))
    share = F.least(F.lit(each) / F.col("n"), F.lit(max_bytes / max(known, 1)) / F.greatest("bytes", F.lit(1)))
    return rows.where((F.col("h") < share * (1 << 30)) | (F.col("h") == F.col("least"))).select("lang", "text")


def fit(docs: DataFrame, learn: Column, rows_per_language: int = 1000, order: int = 4, max_rows: int = 20_000, max_bytes: int = MAX_BYTES) -> PpmModel | SparsePpm | None:
    """Context trees of the training sample; None if it is empty."""
    rows = training_rows(docs, learn, rows_per_language, max_rows, max_bytes=max_bytes)

    def count(batches):
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                codes = _gram_codes(data, offsets, order)
                names, own = np.unique(lang[lo:hi], return_inverse=True)
                of = np.repeat(own, np.diff(offsets)).astype(np.uint64)
                gram, n = np.unique((codes << np.uint64(24)) | of, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names[(gram & np.uint64((1 << 24) - 1)).astype(np.int64)], pa.string()), pa.array((gram >> np.uint64(24)).astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    found = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not found.num_rows:
        return None
    coded = found.column("lang").combine_chunks().dictionary_encode()
    names = sorted(coded.dictionary.to_pylist())
    index = {x: i for i, x in enumerate(names)}
    language = np.array([index[x] for x in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
    return made_model(names, language, found.column("gram").to_numpy().astype(np.uint64), found.column("n").to_numpy().astype(np.float64), order)


def predict(docs: DataFrame, model: PpmModel | SparsePpm | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (posterior of the winner under equal priors), bits_per_byte."""
    held = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def score(batches):
        m = pickle.loads(held.value)  # noqa: S301 - made by this job's driver
        for batch in batches:
            texts = batch.column(1)
            lang, prob, rate = [], [], []
            for lo, hi, data, offsets in text_chunks(texts, 1 << 18):
                whole = texts.slice(lo, hi - lo).to_pylist()
                bits = m.code_lengths(data, offsets) if m else None
                for i, t in enumerate(whole):
                    if m is None or not t or not _LETTER.search(t):
                        lang.append(UNDETERMINED)
                        prob.append(0.0)
                        rate.append(None)
                        continue
                    best = int(np.argmin(bits[i]))
                    lang.append(m.languages[best])
                    prob.append(1.0 / sum(2.0 ** max(-1000.0, bits[i, best] - x) for x in bits[i]))
                    rate.append(float(bits[i, best]) / int(offsets[i + 1] - offsets[i]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(prob, pa.float64()), pa.array(rate, pa.float64())], names=["id", "lang_pred", "score", "bits_per_byte"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string")).mapInArrow(score, "id long, lang_pred string, score double, bits_per_byte double")


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1


#: Bits a byte of raw text, and the bits by which a code must be longer than the raw text to say that no language fits.
RAW_BITS, MARGIN = 8.0, 64.0


def keep_identified(docs: DataFrame, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """Rows whose text is in a learned language, with all their columns.

    A row goes if its text has no letter (null, empty, digits and signs), or if even the language with the shortest code
    takes more than 8 bits a byte and ``margin`` bits: the model then knows its text worse than raw bytes, beyond chance, as with
    scripts and encodings that no training row has.  If nothing could be learned, rows with letters stay.  One pass over
    the rows, without a shuffle.
    """
    model = fit(docs, F.coalesce(~held_out(), F.lit(False)))
    held = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    at = docs.columns.index(text_col)

    def identified(batches):
        m = pickle.loads(held.value)  # noqa: S301 - made by this job's driver
        for batch in batches:
            keep = []
            texts = batch.column(at)
            for lo, hi, data, offsets in text_chunks(texts, 1 << 18):
                bits = m.code_lengths(data, offsets).min(axis=1) if m else np.zeros(hi - lo)
                short = bits <= RAW_BITS * np.diff(offsets) + margin
                keep.extend(bool(t and _LETTER.search(t) and (m is None or short[i])) for i, t in enumerate(texts.slice(lo, hi - lo).to_pylist()))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(identified, docs.schema)


def op1_langid_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, F.coalesce(~held_out(), F.lit(False)))
    out = predict(docs, model).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")
