"""Phrases whose words occur together more often than their parts let expect.

Texts are cut into pieces at punctuation and line ends, pieces into words at
spaces and tabs; A-Z count as lower case. Only windows of the longest length are
counted, one per word: the word and, in columns that lead it, those that follow
in its piece, padded at the end. Their counts are summed to those of shorter
phrases, word by word, as a shorter phrase stands wherever a window begins with
it; no shorter window is ever made. Single words are counted before.

Windows travel as numbers. The most frequent words, at most ``CODES`` of
them, of 1 KB each and 32 MB together, have codes that are sent to all tasks,
three to a 64-bit number; other words are written out. If all words with
``Rule.least`` occurrences have codes, the others are in no candidate, and
windows end before them. Either way the counts of frequent phrases are exact.

A phrase of ``a`` occurrences is scored by the cut that explains it best: with
``l`` and ``r`` occurrences of the parts before and after the cut, the score is
``floor(10^6 * a * a / (l * r))``, and the lowest one counts. All parts of a
frequent phrase are frequent, so only frequent phrases are kept for the joins.
These are joins on written tables, whose hot keys Spark's skew joins divide.
Products are decimals, exact up to counts of 10^14.

Null texts and texts without words give nothing, null languages count as
``und``. Rows are counted as they are, repeated ones too, whatever their ids.
An empty table gives no rows. Texts are read whole; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twintext.llm.common import Scratch, ship_package

CODES = 1 << 20  # words with a code
_BITS, _TOGETHER = 21, 3  # of a code's number, and such numbers in a column of windows
_END, _WRITTEN, _FIRST = 0, 1, 2  # numbers of no word, of words without code, and of the first code
_CODED, _CODED_TOGETHER = 1 << 10, 1 << 25  # bytes of a word with a code, and of all of them, at most
_HELD = 1 << 18  # words of a task read at once, and different ones counted at once
_WINDOWS = 1 << 20  # windows of a task counted at once
_ROWS = 1 << 16  # rows of a batch
_PIECE = 1 << 20  # bytes of a text, unless a single word is longer
_SALTS = 64  # parts in which the phrases of a language are ranked first
_COUNT = "decimal(14,0)"
_DIGITS = bytes(range(33, 126))  # of codes; written-out words have a tilde in front
_STOP = b"."
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _STOP * 10)
_GAP = re.compile(rb"[\x20\x09]")


@dataclass(frozen=True)
class Rule:
    """Phrases of 2 to ``longest`` words with ``least`` occurrences or more.

    A phrase goes if a longer candidate that contains its words has at least
    ``inside`` percent of its occurrences. Of each language the ``first`` ones
    with the highest scores are returned.
    """

    longest: int = 3
    least: int = 10
    inside: int = 50
    first: int = 2000


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words and stops, which stand between pieces, of a text; some at a time."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + _PIECE)
        end = gap.start() if gap else len(text)
        # Stops have become one character, so only spaces and tabs separate.
        yield text[start:end].translate(_PLAIN).replace(_STOP, b" . ").split()
        start = end


def _by_language(batch: pa.RecordBatch, behind: int) -> Iterator[tuple[str, list[bytes], int]]:
    """``(lang, tokens, n)`` of some texts of a language; the first ``n`` tokens count.

    The others, ``behind`` at most, come again in front of what follows them.
    """
    held: dict[str, list[bytes]] = {}
    size = 0
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        tokens = held.setdefault(lang, [])
        for some in _tokens(text.as_py() or b""):
            tokens += some
            size += len(some)
            if size >= _HELD:
                for other, full in held.items():
                    done = max(0, len(full) - behind) if other == lang else len(full)
                    yield other, full, done
                    held[other] = full[done:]
                tokens, size = held[lang], 0
        tokens.append(_STOP)
    for lang, tokens in held.items():
        yield lang, tokens, len(tokens)


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    named = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    return docs.select(named, F.col(text).cast("binary").alias("text"))


def _string(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def _batches(lang: str, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """Rows of a language, some at a time."""
    rows = len(next(iter(columns.values())))
    for start in range(0, rows, _ROWS):
        some = [c.slice(start, _ROWS) for c in columns.values()]
        langs = pa.repeat(pa.scalar(lang, pa.string()), len(some[0]))
        yield pa.RecordBatch.from_arrays([langs, *some], ["lang", *columns])


def word_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, word, f)``: how often each word occurs, and with a null word how many there are."""
    ship_package(docs.sparkSession)

    def rows(lang: str, counts: Counter) -> Iterator[pa.RecordBatch]:
        if counts:
            words, f = _string([None, *counts]), pa.array([counts.total(), *counts.values()], pa.int64())
            yield from _batches(lang, {"word": words, "f": f})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, tokens, _ in _by_language(batch, 0):
                held[lang].update(tokens)
                held[lang].pop(_STOP, None)
                if sum(map(len, held.values())) >= _HELD:
                    for other, counts in held.items():
                        yield from rows(other, counts)
                    held.clear()
        for lang, counts in held.items():
            yield from rows(lang, counts)

    counts = _texts(docs, lang, text).mapInArrow(run, "lang string, word string, f long")
    return counts.groupBy("lang", "word").agg(F.sum("f").alias("f"))


@dataclass(frozen=True)
class Codes:
    """Codes of words; ``complete`` if every word that may be in a candidate has one."""

    words: tuple[bytes, ...]
    complete: bool

    def code(self, number: int) -> bytes:
        digits = bytearray()
        while True:
            digits.append(_DIGITS[number % len(_DIGITS)])
            number //= len(_DIGITS)
            if not number:
                return bytes(digits)

    def numbers(self) -> dict[bytes, int]:
        """Words to the numbers of their codes."""
        return {_STOP: _END, **{w: k for k, w in enumerate(self.words, _FIRST)}}

    def decoder(self) -> Callable[[bytes], bytes]:
        known = {self.code(k): w for k, w in enumerate(self.words)}
        return lambda code: code[1:] if code.startswith(b"~") else known[code]


def codes_of(counts: DataFrame, rule: Rule) -> Codes:
    """Codes of the most frequent words, shorter for more frequent ones."""
    frequent = counts.where(F.col("word").isNotNull() & (F.col("f") >= rule.least))
    frequent = frequent.groupBy("word").agg(F.max("f").alias("f"))
    size = F.octet_length("word")
    short = size <= _CODED
    digits = F.length(F.bin("f"))
    classes = frequent.groupBy(digits.alias("digits")).agg(
        F.count(F.lit(1)).alias("words"),
        F.count_if(short).alias("short"),
        F.sum(F.when(short, size).otherwise(0)).alias("size"),
    )
    least, number, together, complete = 64, 0, 0, True
    for row in sorted(classes.collect(), key=lambda r: -r["digits"]):  # 64 rows at most
        number, together = number + row["short"], together + row["size"]
        fits = number <= CODES and together <= _CODED_TOGETHER
        complete &= fits and row["words"] == row["short"]
        if not fits:
            break
        least = row["digits"]
    chosen = frequent.where(short & (digits >= least)).select(F.col("word").cast("binary").alias("word"), "f")
    rows = sorted((-r["f"], bytes(r["word"])) for r in chosen.collect())
    return Codes(tuple(w for _, w in rows), complete)


def _packed_names(longest: int) -> list[str]:
    return [f"packed{k}" for k in range(-(-longest // _TOGETHER))]


def _shift(place: int) -> int:
    """Where the number of a word stands in its column; earlier words stand higher."""
    return _BITS * (_TOGETHER - 1 - place % _TOGETHER)


def _number(place: int) -> Column:
    """The number of the word at a place of a window."""
    return F.shiftright(f"packed{place // _TOGETHER}", _shift(place)).bitwiseAND(F.lit((1 << _BITS) - 1))


def _written(size: int) -> Column:
    """How many of the first words of a window are written out."""
    return sum(((_number(k) == _WRITTEN).cast("int") for k in range(size)), F.lit(0))


def _beginning(longest: int, size: int) -> list[Column]:
    """The columns of a window, ``size`` words of it kept."""
    kept = []
    for k, name in enumerate(_packed_names(longest)):
        here = min(max(size - k * _TOGETHER, 0), _TOGETHER)
        mask = ((1 << here * _BITS) - 1) << (_TOGETHER - here) * _BITS
        kept.append(F.col(name).bitwiseAND(F.lit(mask).cast("long")).alias(name))
    count = _written(size)
    words = F.call_function("substring_index", F.col("written"), F.lit(" "), count)
    return [*kept, F.when(F.col("written").isNotNull() & (count > 0), words).alias("written")]


def _window(longest: int) -> Column:
    """A window as the codes of its words, written-out words after a tilde, and spaces."""
    base, parts = len(_DIGITS), []
    for place in range(longest):
        number = _number(place)
        code = number - _FIRST
        digits = [F.char(F.lit(_DIGITS[0]) + code % base)]
        limit = base
        while limit < 1 << _BITS:
            digit = F.char(F.lit(_DIGITS[0]) + F.floor(code / limit).cast("long") % base)
            digits.append(F.when(code >= limit, digit).otherwise(""))
            limit *= base
        word = F.concat(F.lit("~"), F.get(F.split("written", " "), _written(place)))
        parts.append(F.when(number >= _FIRST, F.concat(*digits)).when(number == _WRITTEN, word))
    return F.concat_ws(" ", *parts).alias("window")


def longest_windows(
    docs: DataFrame, codes: Codes, rule: Rule = Rule(), lang: str = "lang", text: str = "text"
) -> DataFrame:
    """``(lang, window, f)``: how often each window of the longest length occurs, as codes and spaces.

    Further columns hold the window as it travels: numbers of words in
    ``packed0`` and so on, and in ``written`` the words without code.
    """
    ship_package(docs.sparkSession)
    longest, packed_names = rule.longest, _packed_names(rule.longest)

    def distinct(lang: str, packed: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(packed) == 1:
            values, f = np.unique(packed[0], return_counts=True)
            values = values[None]
        else:
            values, f = np.unique(packed, axis=1, return_counts=True)
        columns = {name: pa.array(np.ascontiguousarray(v)) for name, v in zip(packed_names, values)}
        yield from _batches(lang, {**columns, "written": pa.nulls(len(f), pa.string()), "f": pa.array(f)})

    def spelled(
        lang: str, tokens: list[bytes], columns: list[np.ndarray], packed: np.ndarray, these: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        """Windows with words without code, each on its own."""
        local = {w: k for k, w in enumerate(dict.fromkeys(tokens))}
        words = _string(list(local))
        parts = []
        for k, column in enumerate(columns):
            at = np.minimum(these + k, len(tokens) - 1)
            places = np.fromiter((local[tokens[i]] for i in at.tolist()), "i8", len(at))
            parts.append(words.take(pa.array(places, mask=column[these] != _WRITTEN)))
        written = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
        columns = {name: pa.array(np.ascontiguousarray(v)) for name, v in zip(packed_names, packed[:, these])}
        yield from _batches(lang, {**columns, "written": written, "f": pa.array(np.ones(len(these), "i8"))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, other = codes.numbers(), _END if codes.complete else _WRITTEN
        held: defaultdict[str, list[np.ndarray]] = defaultdict(list)
        size = 0
        for batch in batches:
            for lang, tokens, n in _by_language(batch, longest - 1):
                padded = np.zeros(len(tokens) + longest, "i8")
                padded[: len(tokens)] = np.fromiter(map(numbers.get, tokens, repeat(other)), "i8", len(tokens))
                columns = [padded[:n]]
                for k in range(1, longest):
                    columns.append(np.where(columns[-1] > _END, padded[k : n + k], _END))
                packed = np.zeros((len(packed_names), n), "i8")
                for k, column in enumerate(columns):
                    packed[k // _TOGETHER] |= column << _shift(k)
                kept = columns[0] > _END
                if not codes.complete:
                    written = np.any([c == _WRITTEN for c in columns], axis=0)
                    if written.any():
                        yield from spelled(lang, tokens, columns, packed, np.flatnonzero(written))
                    kept &= ~written
                held[lang].append(packed[:, kept])
                size += n
                if size >= _WINDOWS:
                    for full, some in held.items():
                        yield from distinct(full, np.concatenate(some, axis=1))
                    held.clear()
                    size = 0
        for lang, some in held.items():
            yield from distinct(lang, np.concatenate(some, axis=1))

    keys = ["lang", *packed_names, "written"]
    longs = ", ".join(f"{name} long" for name in packed_names)
    windows = _texts(docs, lang, text).mapInArrow(run, f"lang string, {longs}, written string, f long")
    return windows.groupBy(*keys).agg(F.sum("f").alias("f")).select("*", _window(longest))


def phrase_counts(windows: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(lang, size, window, f)``: phrases of 2 to ``longest`` words with ``least`` occurrences or more.

    Sums of sums: phrases of one more word, and windows that end before it, by
    what they begin with. Frequent phrases go along with the sums, so that each
    sum is made once.
    """
    longest = rule.longest
    keys = ["lang", *_packed_names(longest), "written"]
    found = F.col("f") >= rule.least
    level = windows.select(*keys, "f")
    for size in range(longest - 1, 1, -1):
        full = _number(size) > _END  # has more words
        done = _number(size + 1) > _END if size + 1 < longest else F.lit(False)
        whole, begin = F.lit(longest), F.lit(size)
        sizes = F.when(done, F.array(whole)).when(full & found, F.array(whole, begin)).otherwise(F.array(begin))
        level = level.select(*keys, "f", F.explode(sizes).alias("kept"))
        shorter = _beginning(longest, size)
        columns = [F.when(F.col("kept") == size, c).otherwise(F.col(k)).alias(k) for k, c in zip(keys[1:], shorter)]
        level = level.select("lang", *columns, "f").groupBy(*keys).agg(F.sum("f").alias("f"))
    words = sum(((_number(k) > _END).cast("int") for k in range(longest)), F.lit(0))
    level = level.where(found & (_number(1) > _END))
    return level.select("lang", words.alias("size"), _window(longest), "f")


def _spelled(counts: DataFrame, codes: Codes) -> DataFrame:
    """Windows as phrases of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codes.decoder()
        for batch in batches:
            windows = batch.column("window").view(pa.binary()).to_pylist()
            phrases = _string([b" ".join(map(decode, w.split(b" "))) for w in windows])
            columns = [batch.column("lang"), batch.column("size"), phrases, batch.column("f")]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "f"])

    return counts.mapInArrow(run, "lang string, size int, phrase string, f long")


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def _scored(candidates: DataFrame, counts: DataFrame, rule: Rule) -> DataFrame:
    """``(lang, phrase, a, score, l, r)`` by the lowest scoring cut of each candidate."""
    k = F.col("k")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), k).alias("before"), _part(k + 1, F.col("size")).alias("after")
    )
    parts = counts.where(F.col("size").between(1, rule.longest - 1))
    for side, count in (("before", "l"), ("after", "r")):
        known = parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
        cuts = cuts.join(known, ["lang", side])
    a, left, right = (F.col(c).cast(_COUNT) for c in ("a", "l", "r"))
    million = F.lit(1_000_000).cast("decimal(7,0)")
    cuts = cuts.withColumn("above", million * (a * a)).withColumn("below", left * right)
    cuts = cuts.withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")


def _inside_longer(candidates: DataFrame, rule: Rule) -> DataFrame:
    """``(lang, phrase, most)``: the occurrences of the most frequent longer candidate around a phrase."""
    length = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    inner = candidates.where("size > 2").select("*", length)
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
    inner = inner.select("lang", _part(F.col("start"), F.col("length")).alias("phrase"), "a")
    return inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))


def collocations(docs: DataFrame, rule: Rule = Rule(), lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of each language.

    Ranked by score and occurrences, both descending, then by the bytes of the
    phrase; ``n`` is the number of words of the language.
    """
    if rule.longest < 2 or rule.least < 1:
        raise ValueError("phrases have two words or more and occur")
    scratch = Scratch(docs.sparkSession, "phrases")
    words = scratch.write(word_counts(docs, lang, text), "words")
    codes = codes_of(words, rule)
    windows = longest_windows(docs, codes, rule, lang, text)
    single = words.where(F.col("word").isNotNull() & (F.col("f") >= rule.least))
    single = single.select("lang", F.lit(1).alias("size"), F.col("word").alias("phrase"), "f")
    counts = scratch.write(_spelled(phrase_counts(windows, rule), codes).unionByName(single), "counts")
    candidates = counts.where("size >= 2").withColumnRenamed("f", "a")
    scored = _scored(candidates, counts, rule)
    around = scratch.write(_inside_longer(candidates, rule), "around")
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("most") < rule.inside * F.col("a"), F.lit(True))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # Ranked in parts first, so that no task sees all phrases of a language.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    place = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    kept = kept.withColumn("salt", salt).withColumn("place", place).where(F.col("place") <= rule.first)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    kept = kept.withColumn("rank", rank).where(F.col("rank") <= rule.first)
    totals = words.where("word IS NULL").select("lang", F.col("f").alias("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
