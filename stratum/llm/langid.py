"""Language identification by character language models with interpolated Kneser-Ney smoothing.

A model sees words, that is runs of letters in lower case, as sequences of characters between a start and an end mark.
The models of all languages share sorted arrays of n-gram hashes, one per order, so a character costs one binary
search however many languages there are. Each n-gram has its interpolated probability in each language that has seen
it; a context has the weight that is left for shorter ones.

A text gets the language with the lowest cross-entropy per character. How much a lead counts in ``score``, and from
what cross-entropy on a text is rejected, is set on sampled documents that the models have not seen.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.tables import stored
from stratum.llm.words import mix, runs, slices, stretch_hashes, text_bytes

ORDER = 4
DISCOUNT = 0.75
#: About so many labelled documents of each language are learned from, a fifth of them to set score and rejection.
SAMPLE_PER_LANGUAGE = 1000
#: With more languages than these, training stops with an error; none is left out.
MAX_LANGUAGES = 10_000
#: A text is rejected if it takes more bits per character than any text of its language in the sample, and this share.
MARGIN = 0.10
SCALES = (1, 2, 4, 8, 16, 32, 64, 128)
UNKNOWN = "und"

_START, _END = np.uint32(0x110000), np.uint32(0x110001)
_CACHED_WORDS = 200_000


# --- characters -----------------------------------------------------------------------------------------------------


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case (where it is one character) and letters of the basic plane."""
    lower, letter = np.arange(1 << 16, dtype=np.uint32), np.zeros(1 << 16, bool)
    for code in range(1 << 16):
        text = chr(code)
        letter[code] = text.isalpha()
        if len(small := text.lower()) == 1:
            lower[code] = ord(small)
    return lower, letter


_LOWER, _LETTER = _character_tables()


class LetterWords:
    """Words of some texts as characters. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    def __init__(self, texts: pa.Array):
        data, bounds = text_bytes(texts)
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        basic = codes < 1 << 16
        letter, lower = np.zeros(len(codes), bool), codes.copy()
        letter[basic], lower[basic] = _LETTER[codes[basic]], _LOWER[codes[basic]]
        for code in np.unique(codes[~basic]).tolist():
            letter[codes == code] = chr(code).isalpha()
            small = chr(code).lower()
            lower[codes == code] = ord(small) if len(small) == 1 else code
        self.codes = lower
        self.starts, self.ends, self.first = runs(letter, leads[bounds])

    def hashes(self) -> np.ndarray:
        return stretch_hashes(mix(self.codes.astype(np.uint64) + np.uint64(1)), self.starts, self.ends)

    def characters(self, words: np.ndarray) -> np.ndarray:
        """The words one after another, each between its marks."""
        sizes = self.ends[words] - self.starts[words] + 2
        first = np.cumsum(sizes) - sizes
        within = np.arange(sizes.sum()) - np.repeat(first, sizes)
        at = np.repeat(self.starts[words] - 1, sizes) + within
        out = self.codes[np.clip(at, 0, max(0, len(self.codes) - 1))] if len(self.codes) else np.zeros(0, np.uint32)
        out[first] = _START
        out[first + sizes - 1] = _END
        return out


class Grams:
    """The n-grams of words written one after another between marks: one for each predicted character and order."""

    def __init__(self, characters: np.ndarray, order: int):
        self.values = mix(characters.astype(np.uint64) + np.uint64(1))
        start = characters == _START
        begin = np.maximum.accumulate(np.where(start, np.arange(len(characters)), 0))
        self.at = np.flatnonzero(~start)
        self.begin = begin[self.at]
        self.longest = np.minimum(order, self.at - self.begin + 1)

    def hashes(self, which: np.ndarray, n: int, skip: int = 0, drop: int = 0) -> np.ndarray:
        """Of the n-grams that end at these characters, without the first ``skip`` and the last ``drop`` ones."""
        end = self.at[which] + 1
        return stretch_hashes(self.values, end - n + skip, end - drop)


# --- training -------------------------------------------------------------------------------------------------------


@dataclass
class Level:
    """All n-grams of one order: sorted hashes, and per language the log probability (NaN: not seen there)."""

    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_left: np.ndarray


def _level(counts: list[pd.Series]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate([s.index.to_numpy() for s in counts]))
    table = np.full((len(keys), len(counts)), np.nan, np.float32)
    for column, s in enumerate(counts):
        table[np.searchsorted(keys, s.index.to_numpy()), column] = s.to_numpy()
    return keys, table


def _learn(words: pa.Array, weights: np.ndarray, order: int, alphabet: int) -> list[tuple[pd.Series, pd.Series]]:
    """For each order from 1 on: log probability of each n-gram, and log of what each context leaves to shorter ones."""
    spelled = LetterWords(words)
    grams = Grams(spelled.characters(np.arange(len(spelled.starts))), order)
    size = spelled.ends - spelled.starts + 1
    weight = np.repeat(weights, size)
    seen = []
    for n in range(1, order + 1):
        which = np.flatnonzero(grams.longest >= n)
        table = pd.DataFrame({
            "gram": grams.hashes(which, n), "tail": grams.hashes(which, n, skip=1), "context": grams.hashes(which, n, drop=1),
            "marked": grams.at[which] - n + 1 == grams.begin[which], "n": weight[which],
        })
        seen.append(table.groupby("gram").agg(tail=("tail", "first"), context=("context", "first"), marked=("marked", "first"),
                                              n=("n", "sum")))
    out, below = [], None
    for n, table in enumerate(seen, 1):
        # A shorter n-gram counts by how many characters it follows; one at the start of words, as often as it occurs.
        count = table["n"].astype(float)
        if n < order:
            before = seen[n].groupby("tail").size().reindex(table.index).fillna(0)
            count = count.where(table["marked"], before)
        total = count.groupby(table["context"]).sum()
        kinds = count.groupby(table["context"]).size()
        left = DISCOUNT * kinds / total
        own = (count - DISCOUNT).clip(lower=0) / table["context"].map(total)
        shorter = 1 / alphabet if below is None else table["tail"].map(below)
        below = own + table["context"].map(left) * shorter
        out.append((np.log2(below), np.log2(left)))
    return out


@dataclass
class Model:
    languages: list[str]
    levels: list[Level]
    log_floor: float
    scale: float = 8.0
    limits: tuple[float, ...] = ()
    cache: dict = field(default_factory=dict, repr=False)  # scores of words, per worker

    def word_scores(self, characters: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        grams = Grams(characters, len(self.levels))
        score = np.full((len(grams.at), len(self.languages)), np.nan, np.float32)
        left = np.zeros_like(score)
        for n in range(len(self.levels), 0, -1):
            level = self.levels[n - 1]
            which = np.flatnonzero((grams.longest >= n) & np.isnan(score).any(axis=1))
            found = _lookup(level.grams, level.log_p, grams.hashes(which, n), np.nan)
            new = np.isnan(score[which]) & ~np.isnan(found)
            score[which] = np.where(new, found + left[which], score[which])
            rest = _lookup(level.contexts, level.log_left, grams.hashes(which, n, drop=1), 0)
            left[which] += np.where(np.isnan(rest), 0, rest)
        score = np.where(np.isnan(score), left + self.log_floor, score).astype(np.float64)
        ends = np.flatnonzero(characters[grams.at] == _END)
        return np.add.reduceat(score, np.concatenate([[0], ends[:-1] + 1]), axis=0) if len(ends) else score

    def entropies(self, texts: pa.Array, cache: dict) -> tuple[np.ndarray, np.ndarray]:
        """Per text the bits per character in each language (NaN without letters), and how many characters."""
        words = LetterWords(texts)
        if not len(words.starts):
            return np.full((len(texts), len(self.languages)), np.nan), np.zeros(len(texts), np.int64)
        kinds, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        known = cache.get("words", np.zeros(0, np.uint64))
        table = cache.get("scores", np.zeros((0, len(self.languages))))
        new = np.flatnonzero(~np.isin(kinds, known, assume_unique=True))
        fresh = self.word_scores(words.characters(first[new]))
        if len(known) + len(new) > _CACHED_WORDS:
            keep = np.flatnonzero(np.isin(known, kinds, assume_unique=True))
            known, table = known[keep], table[keep]
        known, table = np.concatenate([known, kinds[new]]), np.concatenate([table, fresh])
        order = np.argsort(known)
        cache["words"], cache["scores"] = known, table = known[order], table[order]
        scores = table[np.searchsorted(known, kinds)][number]
        sizes = words.ends - words.starts + 1
        full = np.flatnonzero(np.diff(words.first))
        out = np.full((len(texts), len(self.languages)), np.nan)
        length = np.zeros(len(texts), np.int64)
        length[full] = np.add.reduceat(sizes, words.first[full])
        out[full] = -np.add.reduceat(scores, words.first[full], axis=0) / length[full, None]
        return out, length

    def decide(self, entropy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language (-1: none) and the share of it when a lead of ``1 / scale`` bits counts as one to e."""
        none = np.isnan(entropy).any(axis=1)
        entropy = np.where(none[:, None], 0, entropy)
        best = entropy.argmin(axis=1)
        share = 1 / np.exp(-self.scale * (entropy - entropy.min(axis=1, keepdims=True))).sum(axis=1)
        return np.where(none, -1, best), np.where(none, 0.0, share)


def _lookup(keys: np.ndarray, table: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), table.shape[1]), missing, np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], table[at], np.float32(missing))


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of each language once per slice, with how often it comes."""
    for batch in batches:
        for part in slices(batch):
            words = LetterWords(part.column("text"))
            langs, lang = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            of = np.repeat(lang, np.diff(words.first))
            if not len(of):
                continue
            _, first, counts = np.unique(words.hashes() + mix(of.astype(np.uint64)), return_index=True, return_counts=True)
            spelled = ["".join(map(chr, words.codes[a:b])) for a, b in zip(words.starts[first], words.ends[first])]
            yield pa.RecordBatch.from_pydict({"lang": langs[of[first]].tolist(), "word": spelled, "n": counts})


def sampled(labelled: DataFrame, per_language: int) -> DataFrame:
    """About so many documents of each language, chosen by a hash of id and text; all of them if there are fewer."""
    counts = labelled.groupBy("lang").count()
    languages = counts.count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} languages; at most {MAX_LANGUAGES} can be learned")
    share = F.least(F.lit(1.0), per_language / F.col("count"))
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.join(F.broadcast(counts), "lang").where(draw < share).select("doc_id", "lang", "text")


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, order: int = ORDER) -> Model | None:
    """A model from ``labelled(doc_id, lang, text)``; rows without text or language are not looked at. None if no row is left.

    Every language that has a letter is learned, however rare. One whose documents would all be set apart is learned from
    these; it then has no limit, and none of its texts is rejected.
    """
    rows = stored(sampled(labelled.select("doc_id", "lang", "text").dropna(subset=["lang", "text"]), per_language))
    apart = F.pmod(F.xxhash64("doc_id", "text", F.lit("apart")), F.lit(5)) == 0
    table = _counted(rows.where(~apart))
    left = rows.join(F.broadcast(rows.sparkSession.createDataFrame([(x,) for x in set(table["lang"])], "lang string")), "lang", "left_anti")
    whole = _counted(left)
    table = pd.concat([t for t in (table, whole) if not t.empty] or [table])
    if table.empty:
        return None
    table = table.sort_values(["lang", "word"])  # the order of sums must not depend on the cluster
    languages = sorted(table["lang"].unique())
    alphabet = len(set("".join(table["word"]))) + 2
    learned = []
    for lang in languages:
        own = table[table["lang"] == lang]
        learned.append(_learn(pa.array(own["word"]), own["n"].to_numpy(), order, alphabet))
    levels = [Level(*_level([p[n][0] for p in learned]), *_level([p[n][1] for p in learned])) for n in range(order)]
    model = Model(languages, levels, float(-np.log2(alphabet)), limits=(float("inf"),) * len(languages))
    return _calibrated(model, rows.where(apart & ~F.col("lang").isin(sorted(set(whole["lang"])))))


def _counted(rows: DataFrame) -> pd.DataFrame:
    counts = rows.select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow().to_pandas()


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Scale: the one under which the true languages of these rows are likeliest. Limits: the hardest text, and a margin."""
    found = rows.select("lang", _entropy_column(model, F.col("text")).alias("found")).select("lang", "found.*").toArrow().to_pandas()
    found = found[found["lang"].isin(model.languages) & (found["length"] > 0)]
    if found.empty:
        return model
    entropy = np.stack(found["bits"].to_numpy())
    true = np.searchsorted(model.languages, found["lang"])
    gap = entropy - entropy.min(axis=1, keepdims=True)

    def surprise(scale: float) -> float:
        return float((scale * gap[np.arange(len(gap)), true] + np.log(np.exp(-scale * gap).sum(axis=1))).mean())

    limits = [float(entropy[true == k, k].max() * (1 + MARGIN)) if (true == k).any() else float("inf") for k in range(len(model.languages))]
    return replace(model, scale=float(min(SCALES, key=surprise)), limits=tuple(limits))


# --- operator -------------------------------------------------------------------------------------------------------


def _each_slice(texts: pa.Array) -> Iterator[pa.Array]:
    for part in slices(pa.RecordBatch.from_arrays([texts], ["text"])):
        yield part.column("text")


def _entropy_column(model: Model, text: Column) -> Column:
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.arrow_udf("bits array<double>, length long")
    def measure(texts: pa.Array) -> pa.Array:
        bits, length, cache = [], [], {}
        for part in _each_slice(texts):
            entropy, sizes = shared.value.entropies(part, cache)
            bits += entropy.tolist()
            length += sizes.tolist()
        return pa.StructArray.from_arrays([pa.array(bits, pa.list_(pa.float64())), pa.array(length, pa.int64())], ["bits", "length"])

    return measure(text)


def identify(text: Column, model: Model | None) -> Column:
    """``lang_pred``, ``score``, ``bits`` per character, and whether the text is ``rejected``.

    A missing text, or one without a letter, is ``und`` with score 0, no bits, and rejected. So is every text if there
    is no model.
    """
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"),
                        F.lit(True).alias("rejected"))
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, bits double, rejected boolean")
    def of(texts: pa.Array) -> pa.Array:
        model = shared.value
        names, scores, bits, rejected = [], [], [], []
        limits = np.array([*model.limits, 0.0])
        for part in _each_slice(texts):
            entropy, _ = model.entropies(part, model.cache)
            best, share = model.decide(entropy)
            own = np.where(best < 0, np.nan, np.take_along_axis(entropy, np.maximum(best, 0)[:, None], 1)[:, 0])
            names += [model.languages[b] if b >= 0 else UNKNOWN for b in best.tolist()]
            scores += share.tolist()
            bits += [None if b < 0 else x for b, x in zip(best.tolist(), own.tolist())]
            rejected += (~(own <= limits[best])).tolist()
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang_pred", "score", "bits", "rejected"])

    return of(text)


def predictions(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of the documents as a struct ``row``, and what ``identify`` says of each text.

    Repeated rows are returned as often as they come; other columns are not looked at.
    """
    whole = docs.select(F.struct("*").alias("row"))
    return whole.select("row", identify(F.col("row.text"), model).alias("found")).select("row", "found.*")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that are not rejected, unchanged."""
    return predictions(docs, model).where(~F.col("rejected")).select("row.*")
