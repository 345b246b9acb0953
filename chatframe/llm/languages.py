"""Languages of documents and of their segments, by rank-order n-gram profiles."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut, spread
from .tokens import slices

LANGS = ("de", "en", "es", "fr", "hi", "hi-latn", "pt")
#: Profiles are fitted on at most about MOST_DOCS documents, from at most MOST_WORDS words a language.
MOST_DOCS, MOST_WORDS, PROFILE = 20_000, 20_000, 6_000
#: A segment of so many words needs this share of known words and this margin to count, a shorter one all words known and the last.
LEAST_WORDS, LEAST_KNOWN, LEAST_MARGIN, SHORT_MARGIN = 3, 0.5, 0.02, 0.1
#: Characters that are judged at once, and words whose n-grams are remembered; neither affects the result.
MOST_LETTERS, MOST_KEPT = 300_000, 300_000

#: Spellings of the languages in labels, lower case, without region.
SPELLINGS = {
    "de": "de deu ger german deutsch", "en": "en eng english inglés englisch", "es": "es spa spanish español espanol castellano", "fr": "fr fra fre french français francais",
    "hi": "hi hin hindi hi-deva हिन्दी हिंदी", "hi-latn": "hi-latn hin-latn hinglish", "pt": "pt por portuguese português portugues",
}
_PREFIX = re.compile(r"^[\s\u200e\u200f\ufeff]*(?:\[?\d{1,4}[./-]\d{1,2}[./-]\d{1,4},?\s+\d{1,2}:\d{2}(?::\d{2})?(?:\s*[apAP]\.?[mM]\.?)?\]?(?:\s+-)?\s*)?(?:[^\s:<>{}\"“”?!,.][^:\n<>{}\"?!]{0,30}:\s+(?=\S))?")
_CODE = re.compile(r"https?://\S+|www\.\S+|\S+@\S+|<\|[^|>\n]*\|>|[@#]\w+|^\s*[{\[]\s*[\"'{\[\d].*[}\]]\s*$", re.M)
_CODE_SIGN = re.compile(r"[@#<{\[/]|www\.")
_NOTICE = re.compile(r"^[\s\u200e<]*(?:(?:media|image|video|audio|sticker|gif|document|contact\s+card|photo|file|voice\s+message)\s+omitted|this\s+message\s+was\s+deleted|you\s+deleted\s+this\s+message|missed\s+(?:voice|video|group)\s+call|messages\s+and\s+calls\s+are\s+end-to-end\s+encrypted.*)[\s>.]*$", re.I)
_SENTENCE = re.compile(r"[.!?।…]+[\"'”)»]*(?=\s|$)|(?<=[^\W\d_])\.{2,}| [-–—] ")
_SOUND = re.compile(r"(.)\1{3,}|(..)\2+.?")
_TOKEN = re.compile(r"[^\W\d_](?:[\w'’ऀ-ॿ]|\u200d(?=[ऀ-ॿ]))*")


def segments(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every message or sentence, without senders and app notices; never overlapping."""
    at = 0
    for line in text.split("\n"):
        body = line.rstrip("\r")
        start = _PREFIX.match(body).end()
        if not _NOTICE.match(body[start:]):
            last = start
            for m in _SENTENCE.finditer(body, start):
                if part := body[last : m.start()].strip():
                    yield (begin := at + body.index(part, last)), begin + len(part)
                last = m.end()
            if part := body[last:].strip():
                yield (begin := at + body.index(part, last)), begin + len(part)
        at += len(line) + 1


def tokens(text: str) -> list[str]:
    """Lower-case words; links, addresses, markers, code and drawn-out sounds (hahaha, aaaa) left out."""
    if _CODE_SIGN.search(text):
        text = _CODE.sub(" ", text)
    words = _TOKEN.findall((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())
    return [w for w in words if w[:2] != w[2:4] or not _SOUND.fullmatch(w)]


def _ngrams(word: str) -> list[str]:
    """Parts of two and three letters, and the word itself, which counts as often as three parts."""
    padded = f"_{word}_"
    return [padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1)] + [f" {word}"] * 3


class Profiles:
    """Ranks of the PROFILE most frequent n-grams of each language; distances of segments to them, many at a time."""

    def __init__(self, rank: dict[str, dict[str, int]] | None = None):
        self.rank = rank or {}
        self.place = {g: i for i, g in enumerate(dict.fromkeys(g for la in LANGS for g in self.rank.get(la, ())))}
        #: log1p of the rank by n-gram and language; the last row stands for n-grams of no profile
        self.log = np.full((len(self.place) + 1, len(LANGS)), math.log1p(PROFILE), np.float32)
        for j, la in enumerate(LANGS):
            for g, i in self.rank.get(la, {}).items():
                self.log[self.place[g], j] = math.log1p(i)
        self._forget()

    def __getstate__(self) -> dict:
        return self.rank

    def __setstate__(self, rank: dict) -> None:
        self.__init__(rank)

    @classmethod
    def of(cls, counts: dict[str, dict[str, int]]) -> Profiles:
        """From word counts by language."""
        rank = {}
        for lang, words in counts.items():
            grams: Counter[str] = Counter()
            for w, n in words.items():
                for g in _ngrams(w):
                    grams[g] += n
            rank[lang] = {g: i for i, (g, _) in enumerate(sorted(grams.items(), key=lambda x: (-x[1], x[0]))[:PROFILE])}
        return cls(rank)

    def _forget(self) -> None:
        self._word: dict[str, int] = {}
        self._grams: list[int] = []
        self._starts: list[int] = [0]
        self._whole: list[int] = []
        self._table: tuple | None = None

    def _words(self, flat: list[str]) -> tuple[np.ndarray, ...]:
        """Numbers of words, and by number the places of their n-grams (start, flat list) and of the word itself."""
        if len(self._word) > MOST_KEPT:
            self._forget()
        for w in set(flat).difference(self._word):
            self._word[w] = len(self._word)
            self._grams += [self.place.get(g, len(self.place)) for g in _ngrams(w)]
            self._starts.append(len(self._grams))
            self._whole.append(self._grams[-1])
            self._table = None
        if self._table is None:
            self._table = np.array(self._starts), np.array(self._grams, np.int32), np.array(self._whole, np.int32)
        return np.fromiter(map(self._word.__getitem__, flat), np.int64, len(flat)), *self._table

    def judge(self, segs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Place in LANGS (-1 if none is sure) and confidence of each segment, given as its words.

        The n-grams of a segment are ranked by their frequency in it, equal ones alike; the out-of-place distance to a
        language is the mean difference of their ranks from those in its profile, in logarithms, each n-gram weighed by
        its frequency; one that the profile lacks is the whole profile away. Confidence is the distance of the second
        language beyond the first, relative to it and to LEAST_MARGIN, as 1 - exp(-x). Segments of fewer than LEAST_WORDS
        words need words that are all known, and a wider margin.
        """
        lens = np.array([len(x) for x in segs], np.int64)
        best, conf = np.full(len(segs), -1), np.zeros(len(segs))
        if not lens.sum():
            return best, conf
        word, starts, grams, whole = self._words([w for x in segs for w in x])
        kind = np.int32 if len(segs) * max(len(self.log), 256) < 2**31 else np.int64  # the narrower sorts and divides faster
        seg = np.repeat(np.arange(len(segs), dtype=kind), lens)
        n = starts[word + 1] - starts[word]
        at = np.repeat(starts[word] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        key = np.repeat(seg, n) * kind(len(self.log)) + grams[at].astype(kind, copy=False)
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key)))
        of, gram = np.divmod(key[first], kind(len(self.log)))
        # ranks in the segment: how many other frequencies are above; n-grams of no profile have none
        order = of * kind(256) + (255 - np.minimum(count, 255)).astype(kind)
        known = gram < len(self.place)
        levels = np.unique(order[known])
        rank = np.searchsorted(levels, order) - np.searchsorted(levels, np.arange(len(segs), dtype=kind) * kind(256))[of]
        out = np.abs(self.log[gram] - np.where(known, np.log1p(rank), 0).astype(np.float32)[:, None])
        heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        mass = np.add.reduceat(count, heads)
        far = np.add.reduceat(out * count[:, None].astype(np.float32), heads) / mass[:, None] / math.log1p(PROFILE)
        full = of[heads]
        two = np.argsort(far, axis=1, kind="stable")[:, :2]
        d0, d1 = (np.take_along_axis(far, two[:, i : i + 1], 1)[:, 0] for i in (0, 1))
        margin = (d1 - d0) / np.maximum(d1, 1e-9)
        seen = (self.log[whole[word]] < math.log1p(PROFILE)).astype(np.int64)
        seen = np.add.reduceat(seen, np.concatenate([[0], np.cumsum(lens[lens > 0])[:-1]]))
        share = np.take_along_axis(seen, two[:, :1], 1)[:, 0] / lens[full]
        long = lens[full] >= LEAST_WORDS
        sure = np.where(long, (share >= LEAST_KNOWN) & (margin >= LEAST_MARGIN), (share == 1) & (margin >= SHORT_MARGIN))
        best[full], conf[full] = np.where(sure, two[:, 0], -1), 1 - np.exp(-margin / LEAST_MARGIN)
        return best, conf

    def documents(self, texts: list[str | None]) -> Iterator[tuple[dict[str, int], list[tuple[int, int, str, float]], str | None, float]]:
        """For each text letters by language, sure segments with confidence, main language and its confidence; empty for
        null texts."""
        for part in slices(texts, MOST_LETTERS):
            spans = [list(segments(t or "")) for t in part]
            said = [tokens(t[a:b]) for t, s in zip(part, spans) for a, b in s]
            best, conf = (x.tolist() for x in self.judge(said))
            i = 0
            for s in spans:
                letters: dict[str, int] = {}
                sure = []
                for a, b in s:
                    if best[i] >= 0:
                        lang = LANGS[best[i]]
                        letters[lang] = letters.get(lang, 0) + sum(map(len, said[i]))
                        sure.append((a, b, lang, conf[i]))
                    i += 1
                main = max(letters, key=lambda x: (letters[x], x)) if letters else None
                mean = sum(c * (b - a) for a, b, la, c in sure if la == main) / sum(b - a for a, b, *_ in sure) if main else 0.0
                yield letters, sure, main, mean


def named(label: str | None) -> set[str]:
    """The languages that a label names, in any known spelling, with or without region; also lists of labels."""
    out = set()
    by = {w: la for la, ws in SPELLINGS.items() for w in ws.split()}
    for part in re.split(r"[,;/+|]|\band\b", (label or "").strip()):
        p = part.strip().lower().replace("_", "-")
        bare = re.sub(r"-(?:[a-z]{2}|\d{3})$", "", p)
        if la := by.get(p) or by.get(bare):
            out.add(la)
    return out


def _count(model: Profiles | None):
    """Words by language: of the label where it names one language, later of the segments that a model is sure of."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, Counter[str]] = {la: Counter() for la in LANGS}
        for pdf in batches:
            wanted = [(t, named(la)) for t, la in zip(pdf["text"], pdf["lang"]) if t is not None]
            if model is None:
                for text, langs in wanted:
                    if len(langs) == 1:
                        counts[next(iter(langs))].update(w for a, b in segments(text) for w in tokens(text[a:b]))
                continue
            for part in slices([t for t, _ in wanted], MOST_LETTERS):
                said = [tokens(t[a:b]) for t in part for a, b in segments(t)]
                for ws, i in zip(said, model.judge(said)[0].tolist()):
                    if i >= 0:
                        counts[LANGS[i]].update(ws)
        yield pd.DataFrame([(la, w, n) for la, ws in counts.items() for w, n in ws.items()], columns=["lang", "word", "n"])

    return run


def below(share: float) -> int:
    """The value that this share of all 64-bit hashes is below."""
    return min(2**63 - 1, -(2**63) + int(share * 2**64))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles from about MOST_DOCS documents, taken by a hash of their key: first by their labels, wrong ones included,
    then twice by the segments that the profiles before are sure of, which drops the wrong ones.

    The documents taken are stored once through the shared folder; all three passes read only these.
    """
    n = max(1, df.count())
    some = df.where(F.xxhash64(key) <= F.lit(below(min(1.0, MOST_DOCS / n)))) if n > MOST_DOCS else df
    some = cut(spread(some.select(F.col(text).alias("text"), F.col(lang).alias("lang"))))
    model: Profiles | None = None
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    for _ in range(3):
        counted = some.mapInPandas(_count(model), "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
        top = counted.withColumn("r", F.row_number().over(first)).where(F.col("r") <= MOST_WORDS).drop("r").collect()
        counts: dict[str, dict[str, int]] = {}
        for r in top:
            counts.setdefault(r["lang"], {})[r["word"]] = r["n"]
        model = Profiles.of(counts)
    return model


def identify(df: DataFrame, model: Profiles, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, main_lang, confidence, langs array<string>, named array<string>, segments array<struct<start, end, lang,
    confidence>> of those in another language than the main one. No language for null, empty and wordless texts."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # PROFILE n-grams a language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            rows = []
            for k, la, (letters, sure, main, conf) in zip(pdf["key"], pdf["lang"], m.documents(pdf["text"].tolist())):
                other = [{"start": a, "end": b, "lang": x, "confidence": c} for a, b, x, c in sure if x != main]
                rows.append((k, main, conf, sorted(letters), sorted(named(la)), other))
            yield pd.DataFrame(rows, columns=["key", "main_lang", "confidence", "langs", "named", "segments"])

    kind = df.schema[key].dataType.simpleString()
    out = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))).mapInPandas(run, f"key {kind}, main_lang string, confidence double, langs array<string>, named array<string>, segments array<struct<start:int,end:int,lang:string,confidence:double>>")
    return out.withColumnRenamed("key", key)


def mislabelled(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, lang: each language of the documents with several, or with one that the label doesn't name."""
    cases = found.where((F.size("langs") > 1) | (F.size(F.array_except("langs", "named")) > 0))
    return cases.select(key, F.explode("langs").alias("lang"))
