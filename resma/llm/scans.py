"""Text of scanned pages repaired into continuous paragraphs.

Words are repaired through a noisy channel: each word that the corpus does not know, or that
may be another, is expanded by the ways characters are misread, weighted by probabilities that
are estimated from the corpus, and the likeliest row of words under the corpus's word pairs is
found by Viterbi. Running headers and footers are lines that come back at the edges of one
source's pages. All counts are made over all pages; what reaches the driver is the language
model: words and pairs above a share of all tokens, so at most one by that share of each.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resma.plans.cut import cut
from resma.plans.lookup import lookup

# How characters can be misread, seen -> meant. How often each happens is estimated (``channel``).
CONFUSIONS = {
    "0": ["o"], "1": ["l", "i"], "!": ["i", "l"], "|": ["l", "i"], "5": ["s"], "$": ["s"], "9": ["g", "q"], "6": ["b", "é", "ó"], "2": ["z"], "8": ["b"], "3": ["e"], "4": ["a"], "7": ["t"],
    "@": ["a"], "€": ["e"], "£": ["e"], "ſ": ["f", "s"], "ﬁ": ["fi"], "ﬂ": ["fl"], "c": ["e", "o"], "e": ["c"], "o": ["c"], "u": ["n"], "n": ["u"], "f": ["t"], "t": ["f"], "v": ["u", "y"], "y": ["v"],
    "rn": ["m"], "m": ["rn", "in", "ni"], "nn": ["m"], "cl": ["d"], "d": ["cl"], "h": ["li", "b"], "li": ["h"], "b": ["h"], "in": ["m"], "ni": ["m"], "vv": ["w"], "ii": ["u", "n"], "ri": ["n"],
    "â": ["ã"], "ä": ["ã", "á"], "ã": ["â"], "à": ["á"], "á": ["à"], "ò": ["ó"], "ì": ["í"], "è": ["é"], "ù": ["ú"], "ö": ["õ", "ó"], "ô": ["õ"], "õ": ["ô"], "ë": ["ê"], "ï": ["í"], "ê": ["é"], "é": ["ê"],
    "c,": ["ç"], "a~": ["ã"], "o~": ["õ"], "~a": ["ã"], "~o": ["õ"], "e^": ["ê"], "a^": ["â"], "o^": ["ô"], "a´": ["á"], "e´": ["é"], "i´": ["í"], "o´": ["ó"], "u´": ["ú"], "a'": ["á"], "e'": ["é"], "i'": ["í"], "o'": ["ó"], "u'": ["ú"], "´a": ["á"], "´e": ["é"],
    ".": [""], "~": [""], "'": [""], "`": [""], "·": [""], "_": [""],
    "�": list("áàâãçéêíóôõú"),
}
STRANGE = frozenset("0123456789!|$@€£ſﬁﬂ�~`·^")
#: Log share of a character misread in a given way before it is estimated, and weight of that share in occurrences.
MISREAD_LOG = math.log(2e-3)
PRIOR = 2000.0
MOST_EDITS = 3

HYPHENS = "-­‐‑¬"
# What may stand around a word.
AROUND = ".,;:()[]{}\"“”‘’«»?…"
NOT_WORD = re.compile(r"@[\w-]+\.|\d{2}|^\d|^[A-Z]{1,3}\d|^www\.|^\W*$|^[^\W\d_]\.?$")

#: Least count of a word or pair, and least share of all tokens: there are at most 1 / share of either, whatever the corpus.
LEAST_WORD = 3
WORD_SHARE, PAIR_SHARE = 1e-7, 3e-7
#: Least share of all sources that have furniture which others share.
SOURCE_SHARE = 1e-6
#: A word so many times rarer than one it may be a misreading of is taken for that.
RARER = 25
#: Two known words are told apart by their neighbours only if the other is so many times likelier there.
SURE = math.log(50)
EDGE = 3

WORD_ROW, PAIR_ROW, EDGE_ROW, INNER_ROW, INNER_HEAD_ROW = range(5)
#: Characters of a key that tell furniture of other sources apart from running text.
HEAD = 12
#: Lines inside pages that could be headings or table labels: short, with a capital or digit first and no stop last.
LABEL = re.compile(r"[A-ZÀ-Þ0-9].{0,58}[^.,;:\-\s]")


def unbroken(text: str) -> str:
    """``text`` with words that a line end breaks made whole."""
    for h in HYPHENS:
        text = text.replace(h + "\n", "")
    return text


def core(token: str) -> str:
    return token.strip(AROUND).lower()


# --- furniture

_n = r"[0-9OolI|SZB]{1,5}"
MARKED = rf"(?:p[áaà4@]g(?:[i1!l]na)?s?\.?|f[l1|]s?\.?|f[o0][l1]has?|p\.)\s*(?:n[º.°]\s*)?{_n}(?:\s*(?:de|/)\s*{_n})?(?:\s*(?:rubrica|v(?:erso)?\.?))?"
BARE = rf"(?:\[\s*{_n}\s*\]|[-–—]\s*{_n}\s*[-–—]|\(\s*{_n}\s*\)|{_n}\s*(?:/|de)\s*{_n}|{_n})"
ROMAN = r"(?=[ivxlc])(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
MARK_LINE = re.compile(rf"[\s\W_]{{0,3}}?(?:({MARKED})|({BARE})|({ROMAN}))[\s\W_]{{0,8}}", re.I)
MARK_START = re.compile(rf"\s*(?:{MARKED}[\s\W_]*|{BARE}(?=[\s\W_])[\s\W_]*|{ROMAN}(?<=[ivxlc])\s+)(?=[^\W\d_])", re.I)
MARK_END = re.compile(rf"[\s|·—–-]+(?:{MARKED}|{BARE}|{ROMAN}(?<=[ivxlc]))[\s\W_]{{0,8}}$", re.I)
ROMAN_EDGE = re.compile(r"^\s*[ivxlc]+\s|\s[ivxlc]+\s*$")
WITHIN = frozenset(HYPHENS + ",;")
DIGITS = frozenset("0123456789")
HAS_DIGIT = re.compile(r"\d")
_alike = bytes.maketrans(b"01!|i5$96@cfyuvq2", b"ollllssgbaetnnngz")
_beside = bytes(c for c in range(128) if not (chr(c).isalnum() or chr(c) in "!|$@"))


def alike(text: str) -> str:
    """``text`` with characters that are misread for each other made one, letters and digits only."""
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKD", low.replace("€", "e").replace("ſ", "f"))
    return low.replace("rn", "m").encode("ascii", "ignore").translate(_alike, _beside).decode()


def number_of(mark: str) -> int | None:
    m = re.search(r"[0-9OolI|SZB]+", mark)
    digits = m.group().translate(str.maketrans("OolI|SZB", "00111528")) if m else ""
    return int(digits) if digits.isdigit() else None


def roman(text: str) -> int:
    values = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
    nums = [values[c] for c in text.lower()]
    return sum(-a if a < b else a for a, b in zip(nums, [*nums[1:], 0]))


def without_mark(line: str) -> str:
    if not HAS_DIGIT.search(line) and not ROMAN_EDGE.search(line):
        return line
    return MARK_END.sub("", MARK_START.sub("", line, count=1), count=1)


def edge_lines(lines: list[str]) -> list[int]:
    """The first and last lines that are not empty, at most EDGE each."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    return sorted({*full[:EDGE], *full[-EDGE:]})


def near(a: str, b: str) -> bool:
    """Whether two keys differ by no more than a few misread characters."""
    if abs(len(a) - len(b)) > max(2, len(b) // 6):
        return False
    x, y = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    return 2 * sum((x & y).values()) >= 0.72 * (sum(x.values()) + sum(y.values()))


def furniture_lines(lines: list[str], page_number: int | None, known: list[str], common: frozenset[str]) -> set[int]:
    """The lines that are running headers, footers or page marks. ``known``: keys of the
    source's furniture; ``common``: keys of furniture met in several sources."""
    edges = edge_lines(lines)
    full = [i for i, x in enumerate(lines) if x.strip()]
    found: set[int] = set()
    for i in edges:
        bare = without_mark(lines[i])
        key = alike(bare)
        whole = key if bare is lines[i] else alike(lines[i])
        if len(key) >= 4 and (key in known or whole in known or key in common or key[:HEAD] in common or any(near(key, k) or near(whole, k) for k in known)):
            found.add(i)
    first, last = full[:EDGE], full[-EDGE:][::-1]
    for side in (first, last):
        for i in side:
            if i in found:
                continue
            m = MARK_LINE.fullmatch(lines[i])
            if m and (m[1] or m[2] or m[3]):
                if m[1]:
                    found.add(i)
                    continue
                bare = re.sub(r"[\W_]+", "", m[2] or m[3]).lower()
                values = {number_of(m[2]) if m[2] else None, roman(bare) if bare and not bare.strip("ivxlc") else None}
                if page_number is None or page_number in values or (m[2] and re.search(r"[\[/–—-]|de", m[2]) and re.search(rf"(?<!\d)0*{page_number}(?!\d)", m[2])):
                    found.add(i)
                    continue
            break  # furniture stands outside of all other lines
    # furniture counts only from the very edge on
    outer: set[int] = set()
    for side in (first, last):
        for i in side:
            if i not in found:
                break
            outer.add(i)
    return outer


# --- language model


@dataclass
class Language:
    words: dict[str, int] = field(default_factory=dict)
    pairs: dict[tuple[str, str], int] = field(default_factory=dict)
    total: int = 1
    #: log share of each misreading (seen, meant)
    channel: dict[tuple[str, str], float] = field(default_factory=dict)
    #: known words that may be misreadings of others
    doubtful: frozenset[str] = frozenset()


def mined_rows(pages: DataFrame) -> DataFrame:
    """(kind, a, b, n) over all pages: words, word pairs, and edge lines by source with their
    page numbers. ``pages``: source, page_number, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter[str] = Counter()
        neighbours: Counter[tuple[str, str]] = Counter()
        edges: set[tuple[str, str, int]] = set()
        inner: Counter[str] = Counter()
        heads: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            cores = {t: core(t) for t in tokens}
            words: Counter[str] = Counter()
            for t, n in tokens.items():
                words[cores[t]] += n
            pairs: Counter[tuple[str, str]] = Counter()
            for (t, u), n in neighbours.items():
                a, b = cores[t], cores[u]
                if a.isalpha() and b.isalpha() and len(a) < 40 and len(b) < 40:
                    pairs[a, b] += n
            rows = [(WORD_ROW, k, None, n) for k, n in words.items() if len(k) < 40 and not NOT_WORD.search(k)]
            rows += [(PAIR_ROW, a, b, n) for (a, b), n in pairs.items()]
            rows += [(EDGE_ROW, *e) for e in edges]
            rows += [(INNER_ROW, k, None, n) for k, n in inner.items()]
            rows += [(INNER_HEAD_ROW, k, None, n) for k, n in heads.items()]
            for c in (tokens, neighbours, edges, inner, heads):
                c.clear()
            cols = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int8(), pa.string(), pa.string(), pa.int64()))], names=["kind", "a", "b", "n"])

        for batch in batches:
            for source, number, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not text:
                    continue
                found = unbroken(text).split()
                tokens.update(found)
                neighbours.update(zip(found, found[1:]))
                lines = text.split("\n")
                at_edge = edge_lines(lines)
                if source is not None:
                    for i in at_edge:
                        # a line within a sentence is no running header
                        if lines[i][0].islower() and lines[i][-1] not in DIGITS or lines[i][-1] in WITHIN:
                            continue
                        key = alike(without_mark(lines[i]))
                        if len(key) >= 4:
                            edges.add((source, key, number if number is not None else -1))
                for i in range(at_edge[0] + EDGE if at_edge else 0, len(lines) - EDGE):
                    line = lines[i]
                    if line and not line[0].islower() and i not in at_edge:
                        heads[alike(line[:24])[:HEAD]] += 1
                        if LABEL.fullmatch(line):
                            inner[alike(without_mark(line))] += 1
            if len(neighbours) > 500_000:
                yield flush()
        yield flush()

    return pages.select("source", "page_number", "text").mapInArrow(run, "kind byte, a string, b string, n long")


def language(rows: DataFrame) -> Language:
    """The language model of mined rows. Words that are misreadings of far more frequent ones are
    no words. The channel is estimated in two rounds from all words that are not known: each
    counts for the ways in which its likeliest known word would have been misread. Both are
    worked out where the words are; the driver gets the model."""
    tokens = rows.where(F.col("kind") == WORD_ROW).agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    counted = cut(rows.where(F.col("kind") == WORD_ROW).groupBy("a").agg(F.sum("n").alias("n")))
    pairs = rows.where(F.col("kind") == PAIR_ROW).groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= max(LEAST_WORD, PAIR_SHARE * tokens))
    out = Language()
    # each word that a far more frequent one may have been misread as is none
    known = counted.where(F.col("n") >= max(LEAST_WORD, WORD_SHARE * tokens))
    out.words = {r["a"]: r["n"] for r in known.collect()}
    out.total = sum(out.words.values()) or 1
    odd = {r["word"] for r in judged_words(known, out, "odd").collect()}
    out.words = {w: n for w, n in out.words.items() if w not in odd}
    for _ in range(2):
        out.channel = channel(counted, out)
    out.doubtful = frozenset(r["word"] for r in judged_words(known, out, "doubtful").collect())
    out.pairs = {(r["a"], r["b"]): r["n"] for r in pairs.collect() if r["a"] in out.words and r["b"] in out.words}
    return out


def judged_words(words: DataFrame, model: Language, what: str) -> DataFrame:
    """(word): those of ``words`` (a, n) that are ``odd`` (RARER times rarer than a word they may be a
    misreading of), or known and ``doubtful`` (some other known word, more frequent, may be meant)."""
    sent = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(sent.value)
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if what == "odd":
                # a word with characters that words have not needs no far more frequent one
                found = [w for w, n in rows if speller.stronger(w, n) or (not STRANGE.isdisjoint(w) and any(speller.words[c] >= n for c, _ in speller.candidates(w)))]
            else:
                found = [w for w, n in rows if w in speller.words and len(w) > 2 and any(speller.words[c] >= n and cost > 1.5 * MISREAD_LOG for c, cost in speller.candidates(w))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

    return words.select("a", "n").mapInArrow(run, "word string")


def channel(words: DataFrame, model: Language) -> dict[tuple[str, str], float]:
    """The log share of each misreading (seen, meant): how often it explains a word that is not
    known, over how often its meant characters occur in known words."""
    sent = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(sent.value)
        counts: Counter[tuple[str, str]] = Counter()
        meant: Counter[str] = Counter()
        of = {m for ms in CONFUSIONS.values() for m in ms if m}
        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if w in speller.words:
                    for m in of:
                        if k := w.count(m):
                            meant[m] += k * n
                elif (best := speller.meant(w)) and (ways := speller.ways(w, best)):
                    for way in ways:
                        counts[way] += n
        rows = [(s, m, n) for (s, m), n in counts.items()] + [(None, m, n) for m, n in meant.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, (pa.string(), pa.string(), pa.int64()))], names=["seen", "meant", "n"])

    # at most one row for each way of CONFUSIONS
    got = words.select("a", "n").mapInArrow(run, "seen string, meant string, n long").groupBy("seen", "meant").agg(F.sum("n").alias("n")).collect()
    occurs = {r["meant"]: r["n"] for r in got if r["seen"] is None}
    total = sum(model.words.values())
    out = {}
    for seen, ms in CONFUSIONS.items():
        for m in ms:
            k = next((r["n"] for r in got if r["seen"] == seen and r["meant"] == m), 0)
            share = (k + PRIOR * math.exp(MISREAD_LOG)) / ((occurs.get(m, 0) if m else total) + PRIOR)
            out[seen, m] = math.log(min(0.1, share))
    return out


def source_furniture(rows: DataFrame) -> tuple[DataFrame, frozenset[str]]:
    """(source, known) with the keys of each source's running lines, and the keys that are
    running lines of at least three sources or begin as such lines do (their first HEAD characters)."""
    edges = rows.where(F.col("kind") == EDGE_ROW).groupBy(F.col("a").alias("source"), F.col("b").alias("key"))
    seen = edges.agg(F.countDistinct("n").alias("on"))
    size = rows.where(F.col("kind") == EDGE_ROW).groupBy(F.col("a").alias("source")).agg(F.countDistinct("n").alias("of"))
    share = seen.where(F.col("on") >= 2).join(size, "source")
    # headings and table labels also stand inside pages
    inside = rows.where(F.col("kind") == INNER_ROW).groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("inside"))
    outside = seen.groupBy("key").agg(F.sum("on").alias("outside"))
    labels = outside.join(inside, "key").where(F.col("inside") >= 0.05 * F.col("outside")).select("key")
    often = share.where((F.col("on") >= 0.2 * F.col("of")) | (F.col("on") >= 8))
    running = cut(often.join(labels, "key", "left_anti"))
    common = running.where(F.col("of") >= 4).groupBy("key").agg(F.count("*").alias("sources")).where(F.col("sources") >= 3)
    least = max(3, SOURCE_SHARE * running.select("source").distinct().count())
    keys = {r["key"] for r in common.where(F.col("sources") >= least).select("key").collect()}
    # how furniture begins, where running text never begins so: for sources of a page or two
    begins = running.groupBy(F.substring("key", 1, HEAD).alias("head")).agg(F.sum("on").alias("outside"), F.countDistinct("source").alias("sources"))
    inner = rows.where(F.col("kind") == INNER_HEAD_ROW).groupBy(F.col("a").alias("head")).agg(F.sum("n").alias("inside"))
    sure = begins.join(inner, "head", "left").where((F.length("head") == HEAD) & (F.col("sources") >= 3) & (F.col("outside") >= 10) & (F.coalesce("inside", F.lit(0)) <= 0.02 * F.col("outside")))
    keys |= {r["head"] for r in sure.where(F.col("sources") >= least).select("head").collect()}
    return running.groupBy("source").agg(F.sort_array(F.collect_set("key")).alias("known")), frozenset(keys)


class Speller:
    """Candidates of words under the misreadings, and the likeliest row of words."""

    KEPT = 500_000

    def __init__(self, model: Language) -> None:
        import ahocorasick

        self.words, self.pairs, self.total, self.doubtful = model.words, model.pairs, model.total, model.doubtful
        self.ways_of = {seen: [(m, model.channel.get((seen, m), MISREAD_LOG)) for m in ms] for seen, ms in CONFUSIONS.items()}
        self.memo: dict[str, list[tuple[str, float]]] = {}
        # tells whether a known word begins so
        self.begins = ahocorasick.Automaton()
        for w in self.words:
            self.begins.add_word(w, True)
        self.own = math.log(0.01 / self.total)

    def candidates(self, word: str) -> list[tuple[str, float]]:
        """All known words that ``word`` may be a misreading of by MOST_EDITS or less, with the log of
        the channel. The word is read from left to right along the beginnings of known words, so
        every way is followed and none that leads nowhere."""
        if word in self.memo:
            return self.memo[word]
        if len(self.memo) > self.KEPT:
            self.memo.clear()
        best: dict[str, float] = {}
        starts = [(word, 0.0)]
        try:
            fixed = word.encode("cp1252").decode("utf-8")
            if fixed != word:
                starts.append((fixed.lower(), MISREAD_LOG))
        except (UnicodeEncodeError, UnicodeDecodeError):
            pass
        if "ã" in word:  # UTF-8 read as Latin-1, in lower case
            for bad, good in (("ã§", "ç"), ("ã£", "ã"), ("ã©", "é"), ("ãª", "ê"), ("ã¡", "á"), ("ã³", "ó"), ("ã´", "ô"), ("ãµ", "õ"), ("ãº", "ú"), ("ã­", "í"), ("ã¢", "â")):
                if bad in word:
                    starts.append((word.replace(bad, good), MISREAD_LOG))
        for text, cost in starts:
            self.follow(text, cost, best)
        best.pop(word, None)
        out = self.memo[word] = list(best.items())
        return out

    def follow(self, text: str, cost: float, best: dict[str, float]) -> None:
        match, ways_of, n = self.begins.match, self.ways_of, len(text)
        stack = [(0, "", cost, MOST_EDITS)]
        while stack:
            at, done, cost, left = stack.pop()
            if at == n:
                if done in self.words and cost > best.get(done, -1e9):
                    best[done] = cost
                continue
            new = done + text[at]
            if match(new):
                stack.append((at + 1, new, cost, left))
            if left:
                for size in (1, 2):
                    for meant, log in ways_of.get(text[at : at + size], ()) if at + size <= n else ():
                        new = done + meant
                        if not meant or match(new):
                            stack.append((at + size, new, cost + log, left - 1))

    def meant(self, word: str) -> str | None:
        """The known word that an unknown one most likely was, or None if itself is likelier."""
        found = [(c + math.log(self.words[w] / self.total), w) for w, c in self.candidates(word)]
        best = max(found, default=(-1e9, ""))
        return best[1] if best[0] > self.own else None

    def ways(self, seen: str, meant: str) -> list[tuple[str, str]]:
        """The misreadings by which ``meant`` was read as ``seen``, the likeliest of all; none if there are none."""
        layers: list[dict[int, tuple[float, list[tuple[str, str]]]]] = [{} for _ in range(len(seen) + 3)]
        layers[0][0] = (0.0, [])
        for i in range(len(seen)):
            for j, (cost, path) in list(layers[i].items()):
                steps = [(1, j + 1, 0.0, None)] if meant.startswith(seen[i], j) else []
                if len(path) < MOST_EDITS:
                    for size in (1, 2):
                        s = seen[i : i + size]
                        steps += [(size, j + len(m), log, (s, m)) for m, log in self.ways_of.get(s, ()) if len(s) == size and meant.startswith(m, j)]
                for size, to, log, way in steps:
                    if to not in layers[i + size] or cost + log > layers[i + size][to][0]:
                        layers[i + size][to] = (cost + log, [*path, way] if way else path)
        return layers[len(seen)].get(len(meant), (0.0, []))[1]

    def stronger(self, word: str, n: int) -> bool:
        """Whether a word that ``word`` may be a misreading of is RARER times as frequent, and as many
        times more for each further misreading as one is rare."""
        return any(self.words[c] * math.exp(cost - MISREAD_LOG) >= RARER * n for c, cost in self.candidates(word))

    def chance(self, before: str | None, word: str) -> float:
        p = (self.words.get(word, 0) + 0.01) / self.total
        seen = self.words.get(before, 0) if before is not None else 0
        if not seen:
            return math.log(p)
        return math.log(0.6 * self.pairs.get((before, word), 0) / seen + 0.4 * p)

    def options(self, word: str) -> list[tuple[str, float]]:
        """What a word may have been, with the log of the channel. A known word that is doubtful
        gives way only to what is far likelier (SURE)."""
        if word not in self.words:
            return [(word, 0.0), *self.candidates(word)]
        if word in self.doubtful:
            return [(word, 0.0), *((w, c - SURE) for w, c in self.candidates(word) if self.words[w] >= self.words[word])]
        return [(word, 0.0)]

    def likeliest(self, words: list[str]) -> list[str]:
        """The likeliest words that ``words`` were, by Viterbi over their options."""
        columns = list(map(self.options, words))
        best: list[tuple[float, list[int]]] = [(self.chance(None, w) + c, [k]) for k, (w, c) in enumerate(columns[0])]
        for at in range(1, len(columns)):
            row = []
            for k, (w, c) in enumerate(columns[at]):
                score, path = max(((s + self.chance(columns[at - 1][p[-1]][0], w), p) for s, p in best), key=lambda x: x[0])
                row.append((score + c, [*path, k]))
            best = row
        path = max(best, key=lambda x: x[0])[1]
        return [columns[i][k][0] for i, k in enumerate(path)]


# --- pages


def recased(word: str, like: str) -> str:
    if like.isupper() and len(like) > 1:
        return word.upper()
    return word[:1].upper() + word[1:] if like[:1].isupper() else word


@dataclass
class PageResult:
    found: list[tuple[int, str]]
    paragraphs: str


class OddWords(dict):
    """Tokens to their core if that is a word the corpus does not know or doubts, else to None."""

    KEPT = 1_000_000

    def __init__(self, model: Language) -> None:
        super().__init__()
        self.words, self.doubtful = model.words, model.doubtful

    def __missing__(self, token: str) -> str | None:
        if len(self) >= self.KEPT:
            self.clear()
        c = core(token)
        odd = len(c) > 1 and (c not in self.words or c in self.doubtful) and not NOT_WORD.search(token.strip(AROUND))
        found = self[token] = c if odd else None
        return found


def is_broken(token: str) -> bool:
    """Whether a word goes on after ``token``, the last of its line."""
    return len(token) > 1 and token[-1] in HYPHENS and token[-2].isalpha()


def may_go_on(tokens: list[str]) -> bool:
    """Whether a broken word may go on with the first of ``tokens``."""
    return bool(tokens) and (tokens[0][:1].isalnum() or tokens[0][:1] in "@€!|")


class PageReader:
    def __init__(self, model: Language, common: frozenset[str] = frozenset()) -> None:
        self.speller, self.common = Speller(model), common
        self.words = model.words
        self.odd = OddWords(model).__getitem__

    def border(self, text: str, page_number: int | None, known: list[str]) -> tuple[str | None, bool]:
        """The first running token if a word may go on with it, and whether the last one is broken."""
        lines = text.split("\n")
        furniture = furniture_lines(lines, page_number, known, self.common)
        running = [i for i in range(len(lines)) if i not in furniture and lines[i].strip()]
        if not running:
            return None, False
        head, tail = lines[running[0]].split(), lines[running[-1]].split()
        broken = is_broken(tail[-1])
        goes_on = may_go_on(head) and not (broken and len(running) == len(head) == 1)
        return head[0] if goes_on else None, broken

    def read(self, text: str, page_number: int | None, known: list[str], repair: bool = True, rest: str | None = None, taken: bool = False) -> PageResult:
        """What is wrong with each line (from 1), and the repaired paragraphs. ``rest``: what of the
        page's last word stands on the next page; ``taken``: the first word belongs to the page before."""
        lines = text.split("\n")
        furniture = furniture_lines(lines, page_number, known, self.common)
        found = [(i + 1, "furniture") for i in furniture]
        running = [i for i in range(len(lines)) if i not in furniture and lines[i].strip()]
        split = {i: lines[i].split() for i in running}
        if taken and running:
            split[running[0]] = split[running[0]][1:]
            if not split[running[0]]:
                running = running[1:]
        # words broken at line ends: the rest moves to the line where the word begins
        page_end = None
        for k, i in enumerate(running):
            token = split[i][-1] if split[i] else ""
            if not is_broken(token):
                continue
            if k + 1 < len(running):
                after = split[running[k + 1]]
                if not may_go_on(after):
                    continue
                split[running[k + 1]] = after[1:]
                split[i] = [*split[i][:-1], self.joined(token[:-1], after[0])]
            elif rest:
                split[i] = [*split[i][:-1], self.joined(token[:-1], rest)]
            else:
                page_end = i
            found.append((i + 1, "broken_word"))
        mended = dict(split)
        for at, i in enumerate(running):
            odd = list(map(self.odd, split[i]))
            if not any(odd):
                continue
            if where := self.misread(split[i], odd, at == 0 and not taken, page_end == i):
                found.append((i + 1, "misread"))
                if repair:
                    mended[i] = [t.replace(t.strip(AROUND), recased(where[k], t.strip(AROUND))) if where.get(k) else t for k, t in enumerate(split[i])]
        return PageResult(sorted(found), paragraphs(lines, running, mended, furniture) if repair else "")

    def joined(self, head: str, rest: str) -> str:
        """A word broken at a line end, with its own hyphen if it has one."""
        whole, apart = head + rest, f"{head}-{rest}"
        a, w = self.words.get(core(apart), 0), self.words.get(core(whole), 0)
        return apart if a > w or (not w and "-" in head) else whole

    def misread(self, tokens: list[str], odd: list[str | None], first: bool, last: bool) -> dict[int, str]:
        """The misread words of a line by place, with what they were ('' if that is not known)."""
        places = [k for k, c in enumerate(odd) if c]
        # the page may begin within a word, and end within one
        if first and places[0] == 0 and tokens[0][:1].islower():
            places = places[1:]
        if last and places and places[-1] == len(tokens) - 1 and not any(c in STRANGE for c in odd[-1][:-1]):
            places = places[:-1]
        out: dict[int, str] = {}
        cores = [core(t) for t in tokens] if places else []
        for a, b in stretches(places, len(tokens)):
            for k, w in enumerate(self.speller.likeliest(cores[a:b]), a):
                if k in places and w != cores[k]:
                    out[k] = w
        for k in places:
            if k not in out and cores[k] not in self.words and misformed(cores[k]):
                out[k] = ""
        return out


def stretches(odd: list[int], n: int) -> list[tuple[int, int]]:
    """Stretches of a line around odd words, with one known word on either side."""
    out: list[tuple[int, int]] = []
    for k in odd:
        a, b = max(0, k - 1), min(n, k + 2)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


LETTERS_AROUND = re.compile(r"[^\W\d_][0-9!|$@€£ſﬁﬂ�^]+(?=[^\W\d_])|^[!|$@€£ſﬁﬂ�5][^\W\d_]{2}|[^\W\d_]{2}[!|@€£�0~]$|[^\W\d_]{2}[5@€|!]$")


def misformed(word: str) -> bool:
    """Whether a word that fits no known one holds characters that no word has."""
    return len(word) > 2 and bool(LETTERS_AROUND.search(word)) and "@" not in word[1:-1].replace("@", "", 1)


def paragraphs(lines: list[str], running: list[int], mended: dict[int, list[str]], furniture: set[int]) -> str:
    """The running text: lines of a paragraph joined, blank lines between paragraphs, short
    lines (headings, tables) left alone."""
    if not running:
        return ""
    lengths = sorted(len(lines[i]) for i in running)
    width = lengths[int(len(lengths) * 0.9)] if lengths else 0
    out: list[str] = []
    before: int | None = None
    for i in running:
        words = " ".join(mended[i])
        blank = before is None or any(j not in furniture and not lines[j].strip() for j in range(before + 1, i))
        if before is not None and not blank and len(lines[before]) >= 0.72 * width:
            out[-1] = f"{out[-1]} {words}".rstrip() if words else out[-1]
        elif words:
            if out and blank:
                out.append("")
            out.append(words)
        before = i
    return "\n".join(out)


def carried(ready: DataFrame, sent: Broadcast) -> DataFrame:
    """(place, rest, taken): words that go on on the next page of the same source and
    configuration. ``rest`` is what the page takes from the next one, ``taken`` tells that its
    own first word goes to the page before. ``ready``: place, next_place, page_number, known, text.

    Where rows of one page differ in these words, nothing is carried, so no word is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = PageReader(*sent.value)
        for batch in batches:
            borders = [reader.border(text, number, keys or []) for number, keys, text in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            first, broken = zip(*borders) if borders else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(first, pa.string()), pa.array(broken, pa.bool_())], names=["place", "next_place", "first", "broken"])

    whole = ready.where((F.col("text") != "") & F.col("next_place").isNotNull()).select("place", "next_place", "page_number", "known", "text")
    borders = whole.mapInArrow(run, "place string, next_place string, first string, broken boolean").where("broken OR first IS NOT NULL")
    alike = (F.min("first") == F.max("first")) & (F.count("first") == F.count("*"))
    pages = cut(borders.groupBy("place").agg(F.first("next_place").alias("next_place"), F.when(alike, F.min("first")).alias("first"), F.min("broken").alias("broken")))
    heads = pages.where("first IS NOT NULL").select(F.col("place").alias("next_place"), F.col("first").alias("rest"))
    pairs = pages.where("broken").select("place", "next_place").join(heads, "next_place")
    sides = pairs.select("place", "rest", F.lit(False).alias("taken")).unionByName(pairs.select(F.col("next_place").alias("place"), F.lit(None).cast("string").alias("rest"), F.lit(True).alias("taken")))
    return sides.groupBy("place").agg(F.max("rest").alias("rest"), F.max("taken").alias("taken"))


def read_pages(pages: DataFrame, found: bool, key: str = "page_id", source: str = "source_sha256", configuration: str = "configuration_sha256") -> DataFrame:
    """``pages``: key, source, page_number, text, and configuration if they have one. With ``found``: (key, line_no, kind), one row
    per line and kind; else (key, text_out).

    A null or empty text has no findings; its text_out is null or empty. Pages of a null source
    have only page marks and furniture that other sources share. Repeated pages are told alike.
    In text_out a word that goes on on the next page stands whole on the page where it begins;
    pages of a null source or number have no next page.
    """
    part = F.col(configuration) if configuration in pages.columns else F.lit(None)
    named = pages.select(F.col(key).alias("key"), F.col(source).alias("source"), part.cast("string").alias("part"), "page_number", "text")
    # kept on disk, compressed; what a lost executor held is mined again
    rows = mined_rows(named.where(F.col("text") != "")).persist(StorageLevel.DISK_ONLY)
    model = language(rows)
    known, common = source_furniture(rows)
    known = cut(known)
    rows.unpersist()
    sent = pages.sparkSession.sparkContext.broadcast((model, common))  # bounded by WORD_SHARE, PAIR_SHARE and SOURCE_SHARE
    ready = lookup(named.where(F.col("text") != "") if found else named, known, "source")
    if not found:
        place = lambda n: F.when(F.col("source").isNotNull() & n.isNotNull(), F.to_json(F.array(F.col("source").cast("string"), "part", n.cast("string"))))
        number = F.col("page_number").cast("long")
        # rows without a place are spread by their text
        ready = ready.withColumns({"next_place": place(number + 1), "place": F.coalesce(place(number), F.concat(F.lit("#"), F.xxhash64("text").cast("string")))})
        ready = lookup(ready, carried(ready, sent), "place", salts=1)
    ready = ready.select("key", "page_number", "known", "text", *([] if found else ["rest", "taken"]))
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = PageReader(*sent.value)
        for batch in batches:
            at, line_no, kinds, texts = [], [], [], []
            for i, (number, keys, text, *carry) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                if not text:
                    texts.append(text)
                    continue
                rest, taken = carry or (None, False)
                result = reader.read(text, number, keys or [], repair=not found, rest=rest, taken=bool(taken))
                texts.append(result.paragraphs)
                for n, k in result.found:
                    at.append(i)
                    line_no.append(n)
                    kinds.append(k)
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(line_no, pa.int64()), pa.array(kinds, pa.string())], names=[key, "line_no", "kind"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text_out"])

    return ready.mapInArrow(run, f"`{key}` {kind}, line_no long, kind string" if found else f"`{key}` {kind}, text_out string")
