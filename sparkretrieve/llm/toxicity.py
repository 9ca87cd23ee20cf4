"""Toxicity scores of texts restored through a noisy channel.

1. Words are split at white space; three or more single characters in a row are
   one word that was spaced out. Every distinct word is counted once.
2. A character trigram model is counted from the distinct words of all
   documents. A word that looks disguised (letters mixed with digits or
   symbols, no letter at all, symbols like letters at its ends, or a letter
   three times in a row) spans a lattice: each run of a character may stand for
   letters that look like it, for fewer copies, or for nothing, each at a cost.
   So does a run of short tokens with an uncommon one among them, where a space
   may end a word or stand for nothing. The Viterbi path of the lattice under
   the trigram model is the restored word, or words.
3. From labelled rows, restored words and their beginnings get log-odds; a
   bounded lexicon of the most telling ones is kept. A document is described
   by its strongest evidence, and a logistic regression, fitted on labelled
   rows that the lexicon has not seen, turns that into a probability.

Only distinct words are shuffled. The classifier is fitted on a bounded sample
of labelled rows: at most ``MAX_LABELS`` (a million) tell the words and at most
``MAX_FIT_ROWS`` (20,000) fit the regression, both chosen by a hash of the
identifier. Its lexicon has at most ``LEXICON`` (50,000) features, the most
telling ones; runs of tokens of which all are among the ``COMMON_WORDS`` (4096)
most common short words are not decoded. These, the trigram model and the
labels are all that is broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretrieve.llm.common import Shared, map_batches, materialise, process_cache

MAX_LABELS = 1_000_000
MAX_FIT_ROWS = 20_000
LEXICON = 50_000
MIN_DOCS = 3
MIN_ODDS = 1.0
STRONG_ODDS = 3.0
BEGINNINGS = (3, 4, 5, 6)
BEAM, LONG = 6, 12  # of a word of so many runs, a good path through so many states is looked for before the best
CACHE_WORDS = 300_000
CACHE_PARTS = 100_000
COUNTER_WORDS = 300_000
SHORT = 3  # letters of a token that may be a part of a spaced word
COMMON_WORDS, COMMON_SHARE = 4096, 0.01  # short words in that share of the documents are common

# Letters that a character may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou",
}
# Costs in nats: reading a character as a letter, dropping copies, dropping a run
# (of symbols, of symbols that look like letters, of digits, of letters).
READ, FEWER, DROP_SYMBOL, DROP_ALIKE, DROP_DIGIT, DROP_LETTER = 0.5, 1.0, 1.0, 2.5, 4.0, 9.0
EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$") + "…“”‘’«»–—¡¿·•"
CLASSES = 64
# Ends that are never read as letters, and symbols that cost nothing to drop at a word's start and end.
MARKS = "".join(c for c in EDGE if c not in LOOKS_LIKE)
FREE_START, FREE_END = "(*", "!*"
JOIN = 0.5  # dropping a space
LITERAL = math.log(CLASSES)  # a character of a word without letters, read as it is


def words_of(text: str | None) -> list[str]:
    """Lower-case words; three or more single letters, digits or symbols in a row are joined."""
    return _joined((text or "").lower().split())


def _joined(words: list[str]) -> list[str]:
    if list(map(len, words)).count(1) < 3:
        return words
    one = [k for k, w in enumerate(words) if len(w) == 1]
    if not any(c - a == 2 for a, c in zip(one, one[2:], strict=False)):
        return words
    out, run = [], []
    for w in [*words, ""]:
        if len(w) == 1:
            run.append(w)
            continue
        out += ["".join(run)] if len(run) >= 3 else run
        run = []
        out.append(w)
    return out[:-1]


class _Parts(dict):
    """What a token is in runs of short tokens: no part (0), a part (1) or an
    uncommon part (2); short tokens are remembered, in bounded number."""

    def __init__(self, common: frozenset[str]) -> None:
        super().__init__()
        self.common = common

    def __missing__(self, word: str) -> int:
        if len(word) > SHORT + 2:  # with punctuation
            return 0
        part = word.strip(MARKS)
        kind = 0 if len(part) > SHORT else 2 if part and part not in self.common else 1
        if len(self) < CACHE_PARTS:
            self[word] = kind
        return kind


def spaced_runs(text: str | None, common: frozenset[str] | _Parts) -> list[str]:
    """Runs of two or more short tokens, one of them uncommon: what may be spaced-out words."""
    words = (text or "").lower().split()
    return _runs(words, set(words), common if isinstance(common, _Parts) else _Parts(common))


def _runs(words: list[str], own: set[str], parts: _Parts) -> list[str]:
    """``own``: the distinct words. A run is found from its first uncommon part."""
    uncommon = {w for w in own if len(w) <= SHORT + 2 and parts[w] == 2}
    if not uncommon:
        return []
    out, a, b = [], 0, 0
    for k in [k for k, w in enumerate(words) if w in uncommon]:
        if k < b:
            continue
        a, b = k, k + 1
        while a and parts[words[a - 1]]:
            a -= 1
        while b < len(words) and parts[words[b]]:
            b += 1
        run = [p for w in words[a:b] if (p := w.strip(MARKS))]
        if len(run) >= 2 and any(map(str.isalpha, "".join(run))) and not _all_common(words, a, b, parts.common):
            out.append(" ".join(run))
    return out


def _all_common(words: list[str], a: int, b: int, common: frozenset[str]) -> bool:
    """Whether all short tokens from a to b and around them, with punctuation, are common."""
    if not common.issuperset(words[a:b]):
        return False
    while a and len(words[a - 1]) <= SHORT + 2:
        a -= 1
    while b < len(words) and len(words[b]) <= SHORT + 2:
        b += 1
    return common.issuperset(words[a:b])


def words_and_runs(text: str | None, common: frozenset[str] | _Parts) -> tuple[set[str], set[str]]:
    """``words_of`` and, beside them, ``spaced_runs``; the text is split once."""
    words = (text or "").lower().split()
    own, joined = set(words), _joined(words)
    runs = set(_runs(words, own, common if isinstance(common, _Parts) else _Parts(common)))
    return own if joined is words else set(joined), runs


def stripped(word: str) -> str:
    """Without punctuation at the ends; @ and $ stay unless there are three."""
    word = word.strip(EDGE)
    while word[-3:] in ("$$$", "@@@"):
        word = word.rstrip(word[-1]).strip(EDGE)
    return word


_TRIPLE = re.compile(r"(.)\1\1")


def looks_disguised(word: str) -> bool:
    if word.isalpha():
        return _TRIPLE.search(word) is not None
    return any(c.isalpha() or c in LOOKS_LIKE for c in word)


def _class(c: str) -> int:
    """The trigram model's class of a letter; 0 is a word's edge."""
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (CLASSES - 27)


class Letters:
    """The trigram model as plain numbers, which single look-ups read faster:
    log-probabilities by two classes before and the class itself, the highest
    by the class before and the class, and the highest of each class."""

    def __init__(self, trigrams: np.ndarray) -> None:
        self.p, self.after = trigrams.ravel().tolist(), trigrams.max(axis=0).ravel().tolist()
        self.most = trigrams.max(axis=(0, 1)).tolist()


def _lattice(word: str) -> list[list[tuple[str, float, int, int]]]:
    """Of each run of a character: what it may be read as, its cost, and the
    class and number of the letters read. The last option of a letter drops it."""
    drop_digit = DROP_DIGIT if any(map(str.isalpha, word)) else DROP_LETTER
    runs, k = [], 0
    while k < len(word):
        c, n = word[k], 1
        while k + n < len(word) and word[k + n] == c:
            n += 1
        starts, ends = k == 0, k + n == len(word)
        k += n
        letters = LOOKS_LIKE.get(c, "")
        if c == " ":
            options = [("", JOIN), (" ", 0.0)]
        elif c.isalpha():
            options = [(c * min(n, 2), FEWER * (n > 2)), (c, FEWER)] if n > 1 else [(c, 0.0)]
            options.append(("", DROP_LETTER))
        else:
            free = (starts and c in FREE_START) or (ends and c in FREE_END)
            options = [("", 0.0 if free else drop_digit if c.isdigit() else DROP_ALIKE if letters else DROP_SYMBOL)]
            for x in letters:
                options.append((x, READ + FEWER * (n > 1)))
                if n > 1:
                    options.append((x * 2, 2 * READ + FEWER * (n > 2)))
        runs.append([(read, cost, 0 if read in ("", " ") else _class(read[0]), len(read)) for read, cost in options])
    return runs


def _walk(runs: list, letters: Letters, least: float = -math.inf, ahead: list | None = None,
          widest: int | None = None) -> tuple[float, tuple, list[dict]]:
    """The best path: its score, its parts as (path before, letters), and the states
    before each run and at the end. A state that cannot reach ``least`` with the
    best that is ``ahead`` is left. With ``widest``, a good path: only so many
    states, those with the best scores, are followed at each step."""
    p = letters.p
    # Of each two letters before (as one number): the score, and the path.
    steps: list[dict[int, tuple[float, tuple]]] = [{0: (0.0, ())}]
    for k, options in enumerate(runs):
        after: dict[int, tuple[float, tuple]] = {}
        by_two, by_last, rest = ahead[k + 1] if ahead else ({}, {}, math.inf)
        for two, (score, path) in steps[-1].items():
            for read, cost, z, size in options:
                s, to = score - cost, two
                if z:
                    s += p[to << 6 | z]
                    to = (to & 63) << 6 | z
                    if size == 2:
                        s += p[to << 6 | z]
                        to = z << 6 | z
                elif size:
                    s, to = s + p[to << 6], 0
                if to in after and s <= after[to][0]:
                    continue
                if s + (by_two[to] if to in by_two else by_last.get(to & 63, rest)) >= least:
                    after[to] = (s, (path, read) if read else path)
        if widest and len(after) > widest:
            after = dict(sorted(after.items(), key=lambda x: x[1][0], reverse=True)[:widest])
        steps.append(after)
    score, path = max(((s + p[two << 6], path) for two, (s, path) in steps[-1].items()), key=lambda x: x[0])
    return score, path, steps


def _ahead(runs: list, letters: Letters, steps: list[dict]) -> list[tuple[dict[int, float], dict[int, float], float]]:
    """No path scores more than this before each run and at the end: by the two
    letters before it, by the last letter, and after any letters. ``steps``: the
    states of the paths that drop no letter; to others the last two apply."""
    p, after, most = letters.p, letters.after, letters.most
    by_two = {two: p[two << 6] for two in steps[-1]}
    by_last = {two & 63: after[(two & 63) << 6] for two in steps[-1]}
    rest = most[0]
    out = [(by_two, by_last, rest)]
    for options, states in zip(reversed(runs), reversed(steps[:-1]), strict=True):
        two_next, last_next, rest_next = by_two, by_last, rest
        by_two, by_last, rest = {}, {}, -math.inf
        for _, cost, z, size in options:
            if z:
                s = most[z] - cost + (last_next[z] if size == 1 else after[z << 6 | z] + two_next[z << 6 | z])
            else:
                s = (most[0] + two_next[0] if size else rest_next) - cost
            rest = max(rest, s)
        for two in states:
            last = two & 63
            best, best_last = -math.inf, by_last.get(last)
            own = best_last is None
            if own:
                best_last = -math.inf
            for _, cost, z, size in options:
                if z:
                    to = last << 6 | z
                    s = -cost
                    if size == 2:
                        s += p[to << 6 | z]
                        to = z << 6 | z
                    s += two_next[to]
                    seen, any_two = s + p[two << 6 | z], s + after[last << 6 | z]
                elif size:
                    s = two_next[0] - cost
                    seen, any_two = s + p[two << 6], s + after[last << 6]
                else:
                    any_two = last_next.get(last, rest_next) - cost
                    seen = two_next[two] - cost if two in two_next else any_two
                if seen > best:
                    best = seen
                if own and any_two > best_last:
                    best_last = any_two
            by_two[two] = best
            by_last[last] = best_last
        out.append((by_two, by_last, rest))
    out.reverse()
    return out


def _best(word: str, letters: Letters) -> tuple[float, str]:
    """The Viterbi path through the lattice of a word, or of tokens with spaces
    between, and its score. The best path that drops no letter comes first; only
    if one that does may score more, all that can reach its score are followed."""
    runs = _lattice(word)
    whole = [[o for o in options if o[1] != DROP_LETTER] or options for options in runs]
    score, path, steps = _walk(whole, letters)
    ahead = _ahead(runs, letters, steps)
    slack = 1e-9 * (1 - score)
    if ahead[0][0][0] > score + slack:
        good = score
        if len(runs) > LONG:  # the higher the score, the more states are left
            good = max(score, _walk(runs, letters, widest=BEAM)[0])
        score, path, _ = _walk(runs, letters, good - slack, ahead)
    read = []
    while path:
        path, part = path
        read.append(part)
    return score, "".join(reversed(read))


def restore(word: str, letters: Letters) -> str:
    return _best(word, letters)[1]


def clear_word(word: str, letters: Letters) -> str:
    """The restored word, or words with spaces between for a run of tokens."""
    if " " in word:
        return restore(word, letters)
    if word.isalpha() and _TRIPLE.search(word) is None:
        return word
    plain = stripped(word)
    seen = word.strip(MARKS)
    if seen[-3:] in ("$$$", "@@@"):
        seen = plain
    if not looks_disguised(seen):
        return plain
    score, read = _best(seen, letters)
    if not any(map(str.isalpha, seen)) and score <= -LITERAL * max(1, len(plain)):
        return plain  # a number or punctuation
    return read


def features_of(word: str) -> list[str]:
    """The word, and its beginnings marked by a trailing -; of every word of a run."""
    found = []
    for w in word.split(" "):
        found.append(w)
        for n in BEGINNINGS:
            if len(w) <= n:
                break
            found.append(w[:n] + "-")
    return found


def _count_words(docs: DataFrame, id_text_label: tuple[str, str],
                 split: Callable[[str | None], list[str]] = words_of) -> DataFrame:
    """(word, docs, bad, good): documents that hold each raw word, all, and
    labelled 1 and 0; counted in each task first, in bounded memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total, bad, good = Counter(), Counter(), Counter()

        def flush() -> dict:
            words = list(total)
            out = {"word": words, "docs": [total[w] for w in words], "bad": [bad[w] for w in words],
                   "good": [good[w] for w in words]}
            for c in (total, bad, good):
                c.clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(split(text))
                total.update(own)
                if label is not None:
                    (bad if label else good).update(own)
                if len(total) > COUNTER_WORDS:
                    yield flush()
        if total:
            yield flush()

    text, label = id_text_label
    rows = map_batches(docs.select(text, label), "word string, docs long, bad long, good long", run,
                       rows_per_batch=50_000)
    return rows.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("docs", "bad", "good")])


def _trigrams(words: DataFrame) -> np.ndarray:
    """log P(c | a, b) of letter classes, each order interpolated with the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts = np.zeros(CLASSES ** 3)
        for batch in batches:
            clean = [(s, n) for w, n in zip(batch.column("word").to_pylist(), batch.column("docs").to_pylist(), strict=True)
                     if (s := stripped(w)).isalpha() and not looks_disguised(s)]
            if not clean:
                continue
            codes = np.frombuffer("\0\0".join(["", *(s for s, _ in clean), ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
            classes = np.where(codes == 0, 0, np.where((codes >= 97) & (codes <= 122), codes - 96,
                                                       27 + codes % (CLASSES - 27)))
            owner = np.repeat(np.arange(len(clean)), [len(s) + 2 for s, _ in clean])
            n = np.asarray([n for _, n in clean], float)[owner]
            at = np.arange(2, 2 + len(owner))
            # A word of m letters has m + 1 trigrams that end in it or right after it.
            ends = np.cumsum([len(s) + 2 for s, _ in clean]) - 1
            inside = np.ones(len(owner), bool)
            inside[ends] = False
            key = (classes[at - 2] * CLASSES + classes[at - 1]) * CLASSES + classes[at]
            counts += np.bincount(key[inside], n[inside], CLASSES ** 3)
        there = np.flatnonzero(counts)
        yield {"k": there, "n": counts[there].astype(np.int64)}

    sums = map_batches(words, "k int, n long", run).groupBy("k").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES ** 3)
    for row in sums.toLocalIterator():  # at most CLASSES ** 3 rows
        counts[row["k"]] = row["n"]
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * CLASSES)
    p2 = (two + 10 * p1) / (two.sum(axis=1, keepdims=True) + 10)
    p3 = (three + 10 * p2[None]) / (three.sum(axis=2, keepdims=True) + 10)
    return np.log(p3)


def _common(words: DataFrame, n_docs: int) -> frozenset[str]:
    """Short words that many documents hold; at most COMMON_WORDS."""
    best = words.filter((F.length("word") <= SHORT) & (F.col("docs") >= max(MIN_DOCS, COMMON_SHARE * n_docs)))
    return frozenset(r["word"] for r in best.orderBy(F.desc("docs"), "word").limit(COMMON_WORDS).collect())


def _lexicon(words: DataFrame, trigrams: np.ndarray, n_bad: int, n_good: int) -> dict[str, float]:
    """Log-odds of the most telling features of restored words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        letters = Letters(trigrams)
        for batch in batches:
            out: dict[str, list] = {"feature": [], "bad": [], "good": []}
            for word, bad, good in zip(*(batch.column(c).to_pylist() for c in ("word", "bad", "good")), strict=True):
                for f in set(features_of(clear_word(word, letters))):
                    if f and f != "-":
                        out["feature"].append(f)
                        out["bad"].append(bad)
                        out["good"].append(good)
            yield out

    labelled = words.filter("bad + good > 0").select("word", "bad", "good")
    counts = map_batches(labelled, "feature string, bad long, good long", run, rows_per_batch=50_000) \
        .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / F.lit(n_bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(n_good + 1.0))
    best = counts.withColumn("odds", odds).filter((F.col("bad") >= MIN_DOCS) & (F.col("odds") >= MIN_ODDS)) \
        .orderBy(F.desc(F.col("bad") * F.col("odds")), "feature").limit(LEXICON)
    return {r["feature"]: r["odds"] for r in best.collect()}


class _Odds(dict):
    """The strongest log-odds of a raw word, computed when first asked for."""

    def __init__(self, trigrams: np.ndarray, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.letters, self.lexicon = Letters(trigrams), lexicon
        self.starts = {f[:n] for f in lexicon for n in BEGINNINGS}

    def __missing__(self, word: str) -> float:
        clear = clear_word(word, self.letters)
        odds = max(map(self.strongest, clear.split(" "))) if " " in clear else self.strongest(clear)
        if len(self) < CACHE_WORDS and len(word) <= 64:
            self[word] = odds
        return odds

    def strongest(self, word: str) -> float:
        """The highest log-odds of ``features_of`` a word without spaces, or 0."""
        odds, get = 0.0, self.lexicon.get
        for n in BEGINNINGS:
            if word[:n] not in self.starts:  # nor does a longer feature begin like this
                return odds
            if len(word) <= n:
                break
            odds = max(odds, get(word[:n] + "-", 0.0))
        return max(odds, get(word, 0.0))


STATS = ("most", "second", "strong", "weak", "share")


def _evidence(docs: DataFrame, text_col: str, shared: Shared, keep_text: bool = False) -> DataFrame:
    """``docs`` with the STATS of each text, and without it unless ``keep_text``."""
    kept = [f for f in docs.schema if keep_text or f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trigrams, lexicon, common = shared.value
        odds, parts = process_cache("toxicity", shared.id, lambda: (_Odds(trigrams, lexicon), _Parts(common)))
        look_up = odds.__getitem__

        for batch in batches:
            out: dict[str, list] = {s: [] for s in STATS}
            for text in batch.column(text_col).to_pylist():
                own, spaced = words_and_runs(text, parts)
                found = sorted(filter(None, map(look_up, chain(own, spaced))), reverse=True)
                strong = sum(s >= STRONG_ODDS for s in found)
                for name, v in zip(STATS, (found[0] if found else 0.0, found[1] if len(found) > 1 else 0.0,
                                           math.log1p(strong), math.log1p(len(found)),
                                           10.0 * strong / max(1, len(own))), strict=True):
                    out[name].append(v)
            yield {f.name: batch.column(f.name) for f in kept} | out

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{s} double" for s in STATS]
    return map_batches(docs, ", ".join(fields), run)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Weights (the last one constant) by Newton steps with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: its columns (the text only with
    ``keep_text``), and score (0 to 1) and predicted (1 if score >= 0.5).

    ``labels``: (id_col, label_col) with 0 or 1; null labels and identifiers
    are not used, and of repeated identifiers the larger label counts.
    ``learn``: which rows of ``labels`` may be learned from. Nothing but the
    text enters a score. Null and empty texts have no evidence, and the score
    of that. Without labels of both kinds every score is 0. Columns named like
    a result are replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {*STATS, "score", "predicted"}])
    known = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").alias("_text"))
    usable = labels.filter(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    usable = materialise(usable, "labels")
    n = usable.count()
    if n > MAX_LABELS:
        usable = usable.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * 0.98 * MAX_LABELS / n))
    # Three quarters tell the words, one quarter fits the regression.
    fits = F.pmod(F.xxhash64("_id", F.lit("fit")), F.lit(4)) == 0
    lexical = usable.filter(~fits)
    sizes = lexical.groupBy("_label").agg(F.count(F.lit(1)).alias("n"))
    size = {r["_label"]: r["n"] for r in sizes.collect()}  # two rows

    tagged = known.join(F.broadcast(lexical), F.col("_doc") == F.col("_id"), "left").select("_text", "_label")
    words = materialise(_count_words(tagged, ("_text", "_label")), "words")
    trigrams = _trigrams(words)
    common = _common(words, docs.count())
    lexicon = {}
    if len(size) == 2:
        parts = _Parts(common)
        spaced = _count_words(tagged.filter("_label is not null"), ("_text", "_label"), lambda text: spaced_runs(text, parts))
        lexicon = _lexicon(words.unionByName(spaced), trigrams, size[1], size[0])
    shared = Shared(spark, (trigrams, lexicon, common))

    chosen = usable.filter(fits).orderBy(F.xxhash64("_id")).limit(MAX_FIT_ROWS)
    labelled = known.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    sample = _evidence(labelled.select("_text", "_label"), "_text", shared).collect() if lexicon else []
    y = np.asarray([r["_label"] for r in sample], float)
    if lexicon and 0 < y.sum() < len(y):
        w = fit_logistic(np.asarray([[r[s] for s in STATS] for r in sample]), y)
        z = F.lit(float(w[-1]))
        for s, weight in zip(STATS, w, strict=False):
            z = z + F.col(s) * float(weight)
        score = 1 / (1 + F.exp(-z))
    else:
        score = F.lit(0.0)
    found = _evidence(docs, text_col, shared, keep_text)
    return found.withColumn("score", score).drop(*STATS) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

