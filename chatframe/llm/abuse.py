"""Abusive, hateful or sexual content: non-negative positive-unlabelled learning in numpy.

A linear model over word n-grams of disguise-free text is trained from messages judged abusive, a sample of unlabelled
messages and the judged clean ones. The risk of the unlabelled part is corrected by the class prior and kept from going
below zero: R = prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)), to which the judged clean messages add a supervised
share. Only training data is sampled, with documented bounds; every message is scored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import spread

#: Bounds of what is collected for training.
MOST_LABELS, MOST_UNLABELLED, MOST_LISTED = 20_000, 20_000, 20_000
PRIOR_START, CLEAN_SHARE, EPOCHS, RATE, DECAY, FOLDS = 0.05, 0.5, 20, 0.5, 2e-6, 3

#: Letters that look like Latin ones, and signs that stand for letters inside words.
LOOKALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ɡ": "g", "ո": "n", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "υ": "u", "ν": "v", "κ": "k", "τ": "t", "ı": "i"}
LEET = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "8": "b", "9": "g"}
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .\-_*]{1,2}[^\W\d_]){2,}(?![^\W_])")
_DOTTED = re.compile(r"(?:(?<=[^\W\d_])|(?<=[ऀ-ॿ]))(?:\.{1,3}|[_|~^])(?=[^\W\d_]|[ऀ-ॿ])")
_LEET_WORD = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[@$!0-9])[^\W_@$!]*[@$!0-9][\w@$!*]*")
_RUN = re.compile(r"([\w*ऀ-ॿ])\1+")
_INSIDE, _SIGN = re.compile(r"[._|~^]"), re.compile(r"[@$!\d]")
_TOKEN = re.compile(r"[\w*ऀ-ॿ]+")


def _letters(text: str) -> str:
    """Lower case, compatibility forms folded, look-alikes as Latin letters, invisible marks removed."""
    text = unicodedata.normalize("NFKC", text).lower()
    if not text.isascii():
        latin = any("a" <= c <= "z" for c in text)
        text = "".join(LOOKALIKE.get(c, c) if latin else c for c in text if unicodedata.category(c) != "Cf")
    return text


def words(text: str) -> list[str]:
    """Words with spaced, dotted, leet and stretched spellings undone; numbers as 0; stars stay."""
    text = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), _letters(text))
    if _INSIDE.search(text):
        text = _DOTTED.sub("", text)
    if _SIGN.search(text):
        text = _LEET_WORD.sub(lambda m: m[0].rstrip("!") if m[0].rstrip("!").isalpha() else "".join(LEET.get(c, c) for c in m[0].rstrip("!,.?")), text)
    out = _TOKEN.findall(_RUN.sub(r"\1", text))
    return ["0" if w.isdigit() else w.strip("_") for w in out] if _SIGN.search(text) or "_" in text else out


def _near(a: str, b: str) -> bool:
    """Whether a is b with one letter left out, added or changed or two neighbours swapped, or b with stars for letters."""
    if "*" in a:
        if len(a) < 3 or a.strip("*") == "":
            return False
        pattern = re.compile("".join(".{0,6}" if c == "**" else "." if c == "*" else re.escape(c) for c in re.findall(r"\*\*+|.", re.sub(r"\*{2,}", "**", a))))
        return bool(pattern.fullmatch(b))
    if abs(len(a) - len(b)) > 1 or len(b) < 4:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def _shorter(w: str) -> set[str]:
    """w and what is left of it without one letter: two words that are _near, stars aside, have one of these in common."""
    return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}


#: How the words of an n-gram are written in a feature's name.
_FORMS = ("{}", "{} {}", "{} {} {}", "{} _ {}")


class Model:
    """Weights of word n-grams, the words whose misspellings are undone, and the words that are no misspellings."""

    def __init__(self, marked: list[str] = [], common: frozenset[str] = frozenset(), weight: dict[str, float] | None = None, bias: float = 0.0, threshold: float = 0.5):  # noqa: B006
        self.marked, self.common, self.bias, self.threshold = marked, common, bias, threshold
        self._place = {m: i for i, m in enumerate(marked)}
        self._near: dict[str, list[int]] = {}
        for m, i in self._place.items():
            for x in _shorter(m):
                self._near.setdefault(x, []).append(i)
        self._seen: dict[str, str] = {}
        self.learn(weight or {})

    def __getstate__(self) -> tuple:
        return self.marked, self.common, self.weight, self.bias, self.threshold

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def learn(self, weight: dict[str, float]) -> None:
        """Take these weights by feature."""
        self.weight = weight
        parts = {f: f.split(" ") for f in weight}
        self._id = {w: i for i, w in enumerate(dict.fromkeys(w for p in parts.values() for w in p), 1)}  # 0: in no feature
        key = np.array([self._key([self._id[w] for w in p if w != "_" or len(p) != 3], 3 if len(p) == 3 and p[1] == "_" else len(p) - 1) for p in parts.values()], np.int64)
        order = np.argsort(key)
        self._keys, self._weights = key[order], np.array(list(weight.values()))[order]
        self._ids: dict[str, int] = {}

    def _key(self, ids, form: int):
        """One number for the words of an n-gram and its form."""
        out = 0
        for i in ids:
            out = out * (len(self._id) + 1) + i
        return out * len(_FORMS) + form

    def _right(self, w: str) -> str:
        if w in self.common or not self.marked or len(w) < 3 or w in self._place:
            return w
        if w not in self._seen:
            if len(self._seen) > 200_000:
                self._seen.clear()
            near = range(len(self.marked)) if "*" in w else sorted({i for x in _shorter(w) for i in self._near.get(x, ())})
            self._seen[w] = next((self.marked[i] for i in near if _near(w, self.marked[i])), w)
        return self._seen[w]

    def features(self, text: str | None) -> list[str]:
        """The different n-grams of a text: words, two and three in a row, two with one between."""
        if not text:
            return []
        w = [self._right(x) for x in words(text)]
        return list(dict.fromkeys([*w, *(f"{a} {b}" for a, b in zip(w, w[1:])), *(f"{a} {b} {c}" for a, b, c in zip(w, w[1:], w[2:])), *(f"{a} _ {c}" for a, c in zip(w, w[2:]))]))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of abuse of each text; 0 for null and for texts without words. Each different n-gram counts once."""
        said = [words(t) if t else () for t in texts]
        n = np.array([len(x) for x in said], np.int64)
        flat = [w for x in said for w in x]
        if len(self._ids) > 300_000:
            self._ids.clear()
        for w in set(flat).difference(self._ids):
            self._ids[w] = self._id.get(self._right(w), 0)
        ids = np.fromiter(map(self._ids.__getitem__, flat), np.int64, len(flat))
        of = np.repeat(np.arange(len(texts)), n)
        hits = []
        for form, places in enumerate(((0,), (0, 1), (0, 1, 2), (0, 2))):
            if len(ids) <= places[-1] or not len(self._keys):
                continue
            upto = len(ids) - places[-1]
            parts = [ids[p : upto + p] for p in places]
            inside = (of[:upto] == of[places[-1] :]) & np.logical_and.reduce([p > 0 for p in parts])
            key = self._key([p[inside] for p in parts], form)
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            known = self._keys[at] == key
            hits.append(of[:upto][inside][known] * len(self._keys) + at[known])
        text, feature = np.divmod(np.unique(np.concatenate(hits)), len(self._keys)) if hits else (np.empty(0, np.int64), np.empty(0, np.int64))
        z = self.bias + np.bincount(text, self._weights[feature] if len(feature) else None, len(texts))
        return np.where(n > 0, 1 / (1 + np.exp(-z)), 0.0)

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def _train(rows: list[list[int]], kind: np.ndarray, n: int, seed: int = 7, prior: float = PRIOR_START, held: np.ndarray | None = None) -> tuple[np.ndarray, float, float]:
    """Weights, bias and class prior; kind 1 abusive, 0 clean, -1 unlabelled. Adagrad on mini-batches of all kinds.

    Judged rows whose place is in held are left out of training. From them the prior is estimated: where the mean score of
    the unlabelled lies between the held-out clean and abusive ones. Without them the given prior stays.
    """
    rng = np.random.default_rng(seed)
    lens = np.array([len(r) for r in rows])
    flat, at = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.empty(0, np.int64), np.concatenate([[0], np.cumsum(lens)])
    w, g2, b, gb = np.zeros(n), np.full(n, 1e-2), -2.0, 1e-2
    pos, neg, unl = (np.setdiff1d(np.flatnonzero(kind == k), held if held is not None else []) for k in (1, 0, -1))
    apart = [held[kind[held] == k] for k in (1, 0)] if held is not None else []
    if not len(flat):
        return w, b, prior

    def logits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n_ = lens[ids]
        owner = np.repeat(np.arange(len(ids)), n_)
        idx = flat[np.arange(len(owner)) + np.repeat(at[ids] - np.cumsum(n_) + n_, n_)]
        return b + np.bincount(owner, w[idx], len(ids)), idx, owner

    steps = max(30, len(unl) // 1000)
    for epoch in range(EPOCHS):
        for _ in range(steps):
            p, q, u = (rng.choice(x, min(len(x), k), replace=False) if len(x) else x for x, k in ((pos, 200), (neg, 400), (unl, 1000)))
            ids = np.concatenate([p, q, u])
            z, idx, owner = logits(ids)
            s = 1 / (1 + np.exp(-z))
            d = np.zeros(len(ids))
            np_, nq, nu = len(p), len(q), len(u)
            zp, zu = z[:np_], z[np_ + nq :]
            share = CLEAN_SHARE if nq else 0.0
            d[:np_] += prior * (s[:np_] - 1) / max(np_, 1)  # judged abusive as positive
            d[np_ : np_ + nq] += share * (1 - prior) * s[np_ : np_ + nq] / max(nq, 1)  # judged clean
            if nu and np_:
                rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
                if rest >= 0:
                    d[np_ + nq :] += (1 - share) * s[np_ + nq :] / nu
                    d[:np_] -= (1 - share) * prior * s[:np_] / np_
                else:  # unlearn what the unlabelled part was overfitted to
                    d[np_ + nq :] -= 0.1 * (1 - share) * s[np_ + nq :] / nu
                    d[:np_] += 0.1 * (1 - share) * prior * s[:np_] / np_
            grad = np.bincount(idx, d[owner], n)
            grad += DECAY * w
            g2 += grad * grad
            w -= RATE * grad / np.sqrt(g2 + 1e-8)
            gb += d.sum() ** 2
            b -= RATE * d.sum() / np.sqrt(gb)
        if len(unl) and apart and all(map(len, apart)) and epoch >= 2:
            unknown, bad, good = (float((1 / (1 + np.exp(-logits(x)[0]))).mean()) for x in (unl, *apart))
            if bad > good:
                prior = float(np.clip(0.5 * prior + 0.5 * (unknown - good) / (bad - good), 0.01, 0.99))
    return w, b, prior


def _held_out(rows: list[list[int]], kind: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """Scores of the judged texts, which come first, each by a training without its fold of them; the mean prior."""
    judged = np.flatnonzero(kind >= 0)
    fold = np.empty(len(judged), int)
    for k in (0, 1):  # both kinds evenly over the folds
        at = kind[judged] == k
        fold[at] = np.arange(at.sum()) % FOLDS
    scores, priors = np.zeros(len(judged)), []
    for f in range(FOLDS):
        held = judged[fold == f]
        w, b, prior = _train(rows, kind, n, held=held)
        scores[held] = [1 / (1 + np.exp(-(b + w[rows[i]].sum()))) for i in held]
        priors.append(prior)
    return scores, float(np.mean(priors))


def _cut(s: np.ndarray, y: np.ndarray, prior: float) -> float:
    """The lowest cut that serves scores s of judgements y about best, with the abusive ones weighed down to the prior."""
    weigh = np.where(y == 1, prior / (y == 1).mean(), (1 - prior) / (y == 0).mean())
    cuts = np.linspace(0.02, 0.98, 97)
    good = np.array([2 * weigh[(s >= c) & (y == 1)].sum() / (weigh[s >= c].sum() + weigh[y == 1].sum()) for c in cuts])
    return float(cuts[good >= good.max() - 0.01].min())


def fit(labelled: list[tuple[str, int]], unlabelled: list[str], listed: list[str]) -> Model:
    """A model from judged texts, unlabelled texts and a word list, whose words are only spellings to look out for.

    The words that the first training finds telling join the list, misspellings of listed words are undone, and the
    second training is the model. Without abusive examples every score is near the bias.
    """
    texts = [t for t, _ in labelled] + unlabelled
    kind = np.array([k for _, k in labelled] + [-1] * len(unlabelled))
    seen = Counter(w for t in texts for w in set(words(t)))
    marked = [m for m in dict.fromkeys(x for t in listed for x in words(t)) if len(m) > 2]
    both = {0, 1} <= set(kind.tolist())
    for last in (False, True):
        often = max(6, len(texts) // 1500)
        model = Model(marked, frozenset(w for w, n in seen.items() if "*" not in w and n >= often) - frozenset(marked))
        feats = [model.features(t) for t in texts]
        judged = Counter(f for fs, k in zip(feats, kind) if k >= 0 for f in fs)
        free = Counter(f for fs, k in zip(feats, kind) if k < 0 for f in fs)
        names = [f for f in dict.fromkeys([*judged, *free]) if judged[f] + free[f] >= 3 and judged[f]]
        place = {f: i for i, f in enumerate(names)}
        rows = [[place[f] for f in fs if f in place] for fs in feats]
        held, prior = _held_out(rows, kind, len(names)) if both and last else (None, PRIOR_START)
        w, model.bias, _ = _train(rows, kind, len(names), prior=prior)
        weight = {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-3}
        if not last:
            bad = Counter(f for fs, k in zip(feats, kind) if k == 1 for f in fs)
            telling = [f for f in names if " " not in f and len(f) > 3 and weight.get(f, 0) > 0.2 and bad[f] >= 3 and bad[f] > 0.7 * judged[f]]
            marked = list(dict.fromkeys([*marked, *sorted(telling, key=lambda f: (-bad[f], f))]))
    model.learn(weight)
    if held is not None:
        model.threshold = _cut(held, kind[: len(labelled)], prior)
    return model


def train(messages: DataFrame, labels: DataFrame, listed: DataFrame, key: str = "msg_id", text: str = "text") -> Model:
    """fit() on at most MOST_LABELS judged and MOST_UNLABELLED other messages, chosen by a hash of their key.

    A message judged both ways counts as abusive only if most judgements say so; null texts are left out.
    """
    judged = labels.where("abusive is not null").groupBy(key).agg((F.avg("abusive") > 0.5).cast("int").alias("abusive"))
    judged = judged.orderBy(F.xxhash64(key), key).limit(MOST_LABELS)
    once = messages.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(key, text).distinct()
    rows = once.join(judged, key).select(text, "abusive").collect()
    free = once.join(judged.select(key), key, "left_anti").orderBy(F.xxhash64(key), key).limit(MOST_UNLABELLED).select(text).collect()
    words_ = [r[0] for r in listed.select("word").where("word is not null").distinct().limit(MOST_LISTED + 1).collect()]
    if len(words_) > MOST_LISTED:
        raise ValueError(f"more than {MOST_LISTED} listed words")
    return fit(sorted((r[0], r[1]) for r in rows), sorted(r[0] for r in free), sorted(words_))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df with score (double) and abusive (score >= the model's threshold); null and empty texts score 0."""
    df = df.drop("score", "abusive")
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the bounds of its training data

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            s = m.scores(pdf[text].tolist())
            yield pdf.assign(score=s, abusive=s >= m.threshold)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return spread(df).mapInPandas(run, f"{schema}, score double, abusive boolean")
