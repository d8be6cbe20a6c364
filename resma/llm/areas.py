"""Subject areas of documents by class-association rules.

A bounded sample of labelled documents is cut into sentences; each sentence with the words
that lean to an area is a transaction, together with the document's areas. Parallel frequent-
pattern growth finds rules words -> area, and rules context -> foreign for sentences that name
an area their document is not about. Redundant rules are dropped. Every document is then read
once for the words of the remaining rules; the weights of matching rules are summed by area
and turned into probabilities by a monotone calibration on the sample.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resma.plans.cut import cut

#: Most labelled documents the rules are mined from (those first by a hash of their id).
MAX_LABELLED = 5000
#: Fewest documents a word must lean to an area in, and least share of its documents.
MIN_DOCUMENTS = 4
MIN_LEAN = 0.4
#: Standard errors by which a word's share of an area must stand out from chance.
STANDS_OUT = 2.5
#: Words of one transaction; a sentence with more gives several, the most leaning words together.
PART = 6
MIN_CONFIDENCE = 0.55
#: Least part of the strongest area's weight in a sentence at which another area counts there.
BESIDE = 0.4
#: Least smoothed share at which a rule speaks for its area.
MIN_SURE = 0.75
MOST_AREAS = 3
REST = "procedure"

#: What parts words so that they are no pair: all but letters and single spaces.
APART = re.compile(r"(?:[^\w ]|[\d_])+|  +")
SENTENCE_END = re.compile(r"[.;!?]\s|\n")
ENDS = (". ", "; ", "! ", "? ", "\n")


def sentences(text: str) -> list[str]:
    out, start = [], 0
    for m in SENTENCE_END.finditer(text):
        out.append(text[start : m.end()])
        start = m.end()
    out.append(text[start:])
    return [s for s in out if s.strip()]


def items_of(sentence: str) -> set[str]:
    """The words of a sentence and the pairs of words with one space between them."""
    found: set[str] = set()
    for part in APART.sub("|", sentence.lower()).split("|"):
        words = part.split()
        found.update(words)
        found.update(map(" ".join, zip(words, words[1:])))
    return found


APART_WITHIN = re.compile(r"(?:[^\w \n]|[\d_])+|  +")


def items_by_sentence(text: str) -> list[set[str]]:
    """The items of each sentence of ``text``, which is parted as a whole."""
    out = []
    for sentence in APART_WITHIN.sub("|", SENTENCE_END.sub("\n", text.lower())).split("\n"):
        found: set[str] = set()
        for part in sentence.split("|"):
            words = part.split()
            found.update(words)
            found.update(map(" ".join, zip(words, words[1:])))
        if found:
            out.append(found)
    return out


def lower_bound(k: float, n: float, z: float = STANDS_OUT) -> float:
    """The least share that k of n speak for at z standard errors (Wilson)."""
    if n <= 0:
        return 0.0
    p, zz = k / n, z * z / n
    return (p + zz / 2 - z * math.sqrt(max(0.0, p * (1 - p) / n + zz / (4 * n)))) / (1 + zz)


@dataclass
class Rules:
    """Area rules and foreign rules: sets of words and what they tell."""

    areas: dict[frozenset, list[tuple[str, float]]] = field(default_factory=dict)
    foreign: list[frozenset] = field(default_factory=list)
    #: calibration: evidence from which each probability holds
    steps: list[float] = field(default_factory=list)
    probabilities: list[float] = field(default_factory=list)

    def probability(self, evidence: float) -> float:
        k = bisect.bisect_right(self.steps, evidence) - 1
        return self.probabilities[k] if k >= 0 else 0.0


class Matcher:
    """Finds the words of rules in texts, sentence by sentence."""

    def __init__(self, rules: Rules) -> None:
        import ahocorasick

        self.single = {next(iter(k)): v for k, v in rules.areas.items() if len(k) == 1}
        self.several: dict[str, list[tuple[frozenset, list[tuple[str, float]]]]] = defaultdict(list)
        for k, v in rules.areas.items():
            if len(k) > 1:
                self.several[min(k)].append((k, v))
        self.foreign_words = {next(iter(k)) for k in rules.foreign if len(k) == 1}
        self.foreign: dict[str, list[frozenset]] = defaultdict(list)
        for k in rules.foreign:
            if len(k) > 1:
                self.foreign[min(k)].append(k)
        words = {w for k in [*rules.areas, *rules.foreign] for w in k}
        # ends of sentences are found in the same pass as the words
        self.automaton = ahocorasick.Automaton()
        for w in words:
            self.automaton.add_word(w, (len(w), w))
        for end in ENDS:
            self.automaton.add_word(end, (0, end))
        self.automaton.make_automaton()

    def found(self, text: str) -> list[set[str]]:
        """The words of rules in each sentence that has any."""
        low = f" {text.lower()} "
        out: list[set[str]] = []
        sentence: set[str] | None = None
        for at, (size, word) in self.automaton.iter(low):
            if not size:
                sentence = None
            elif not low[at - size].isalpha() and not low[at + 1].isalpha():
                if sentence is None:
                    sentence = set()
                    out.append(sentence)
                sentence.add(word)
        return out

    def evidence(self, text: str) -> dict[str, float]:
        total: dict[str, float] = defaultdict(float)
        single, several, foreign, foreign_words = self.single, self.several, self.foreign, self.foreign_words
        for words in self.found(text):
            if not words.isdisjoint(foreign_words) or (foreign and any(k <= words for w in words if w in foreign for k in foreign[w])):
                continue
            told: dict[str, list[float]] = defaultdict(list)
            for w in words:
                if w in single:
                    for area, weight in single[w]:
                        told[area].append(weight)
                if w in several:
                    for k, rules in several[w]:
                        if k <= words:
                            for area, weight in rules:
                                told[area].append(weight)
            if len(told) == 1:
                for area, v in told.items():
                    total[area] += max(v)
                continue
            most = max((sum(v) for v in told.values()), default=0.0)
            for area, v in told.items():
                # a word or two beside the many of another area are ambiguous words
                if sum(v) >= BESIDE * most:
                    total[area] += max(v)
        return total


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, key: str = "doc_id") -> DataFrame:
    """(key, text, areas) of at most ``most`` labelled documents."""
    ids = labels.where(F.col("area").isNotNull()).groupBy(key).agg(F.collect_set("area").alias("areas"))
    chosen = ids.orderBy(F.xxhash64(key), key).limit(most)
    return cut(docs.select(key, "text").where(F.col("text").isNotNull()).join(F.broadcast(cut(chosen)), key))  # at most ``most`` rows


def item_bags(sample: DataFrame, least: int = MIN_DOCUMENTS) -> tuple[DataFrame, list[str]]:
    """(doc_id, text, areas, given, bags) of the sample and the items: each sentence once as the numbers of
    its items, so that no later step reads the texts for words again. Items met in fewer than
    ``least`` documents can make no rule and are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                # sentence ends part words anyway, so the items of a text are those of its sentences
                counts.update(items_of(text) if text else ())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["item", "n"])

    often = sample.select("text").mapInArrow(count, "item string, n long").groupBy("item").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    names = sorted(r["item"] for r in often.select("item").collect())  # words of a bounded sample
    sent = sample.sparkSession.sparkContext.broadcast({x: i for i, x in enumerate(names)})
    kind = sample.schema["doc_id"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value.get
        for batch in batches:
            bags = [[sorted(n for i in items if (n := of(i)) is not None) for items in items_by_sentence(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, batch.column(2), pa.array(bags, pa.list_(pa.list_(pa.int32())))], names=["doc_id", "text", "areas", "given", "bags"])

    return cut(sample.select("doc_id", "text", "areas").mapInArrow(number, f"doc_id {kind}, text string, areas array<string>, given array<string>, bags array<array<int>>")), names


def parted(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The items of a column of bags one after another, where each sentence begins among them
    (and the end), and where each document begins among the sentences (and the end). Numbers of
    nested lists are costly as Python objects, so no step makes objects of them."""
    inner = bags.flatten()
    ends = lambda lists: np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)])
    return inner.flatten().to_numpy(), ends(inner), ends(bags)


def item_counts(bags: DataFrame) -> DataFrame:
    """(item, area, n): documents of the sample with the item (a number), by area; area '' counts all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sentence_at, document_at = parted(batch.column(0))
            at = sentence_at[document_at].tolist()
            own: dict[str, list[np.ndarray]] = defaultdict(list)
            for start, end, areas in zip(at, at[1:], batch.column(1).to_pylist()):
                each = np.unique(items[start:end])
                for a in ("", *areas):
                    own[a].append(each)
            for a, found in own.items():
                item, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array([a] * len(item), pa.string()), pa.array(n, pa.int64())], names=["item", "area", "n"])

    return bags.select("bags", "areas").mapInArrow(run, "item int, area string, n long").groupBy("item", "area").agg(F.sum("n").alias("n"))


def leaning_items(counts: DataFrame, names: list[str], least: int = MIN_DOCUMENTS, lean: float = MIN_LEAN) -> dict[int, tuple[str, float]]:
    """Items of the bounded sample that lean to an area: item to (area, smoothed share)."""
    # one aggregate, so that the sample is counted once
    best = F.max(F.when(~F.col("area").isin("", REST), F.struct("n", "area"))).alias("best")
    per = counts.groupBy("item").agg(F.max(F.when(F.col("area") == "", F.col("n"))).alias("docs"), best).where((F.col("docs") >= least) & F.col("best").isNotNull())
    share = (F.col("best.n") + 0.5) / (F.col("docs") + 1)
    rows = per.withColumn("share", share).where((F.col("share") >= lean) & (F.col("best.n") >= least)).select("item", "best.area", "share", "best.n", "docs").collect()
    found = {r["item"]: (r["area"], r["share"]) for r in rows if lower_bound(r["n"], r["docs"]) >= lean}
    shares = {names[i]: v[1] for i, v in found.items()}
    # a pair that says no more than one of its words is redundant
    return {i: v for i, v in found.items() if " " not in names[i] or not any(shares.get(w, 0.0) >= v[1] - 0.02 for w in names[i].split(" "))}


class Named:
    """Which sentences name areas by strong words, and which of them none of their document's."""

    def __init__(self, leaning: dict[int, tuple[str, float]], strong: float, size: int) -> None:
        self.areas = {a: k for k, a in enumerate(sorted({a for a, _ in leaning.values()}))}
        #: by item: the number of the area that a strong word names, else -1
        self.of = np.full(size, -1, np.int32)
        for i, (area, share) in leaning.items():
            if share >= strong:
                self.of[i] = self.areas[area]

    def sentences(self, items: np.ndarray, sentence: np.ndarray, document: np.ndarray, about: list[set[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(named, foreign) by sentence; ``sentence`` is that of each item, ``document`` that of
        each sentence, ``about`` the areas of each document."""
        is_about = np.zeros((len(about), len(self.areas)), bool)
        for d, areas in enumerate(about):
            is_about[d, [self.areas[a] for a in areas if a in self.areas]] = True
        area = self.of[items]
        at = np.flatnonzero(area >= 0)
        named, own = np.zeros(len(document), bool), np.zeros(len(document), bool)
        named[sentence[at]] = True
        own[sentence[at[is_about[document[sentence[at]], area[at]]]]] = True
        return named, named & ~own


def foreign_items(bags: DataFrame, leaning: dict[int, tuple[str, float]], size: int, strong: float = 0.75, least: int = MIN_DOCUMENTS) -> dict[int, float]:
    """Context items of sentences that name areas their document is not about, more than half of
    the time, with that share. Not about: neither by the areas it has now nor by those it was given,
    so that what the rules missed once is not taken for foreign ever after. ``size``: how many items
    there are."""
    names = Named(leaning, strong, size)
    leans = np.zeros(size, bool)
    leans[list(leaning)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sentence_at, document_at = parted(batch.column(0))
            sentence, document = (np.repeat(np.arange(len(x) - 1), np.diff(x)) for x in (sentence_at, document_at))
            named, foreign = names.sentences(items, sentence, document, [{*a, *g} for a, g in zip(*(c.to_pylist() for c in batch.columns[1:]))])
            for f, of in ((True, foreign), (False, named & ~foreign)):
                at = np.flatnonzero(of[sentence] & ~leans[items])
                # a document counts once to each of its items
                each = np.unique(document[sentence[at]] * size + items[at]) % size
                item, n = np.unique(each, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array([f] * len(item), pa.bool_()), pa.array(n, pa.int64())], names=["item", "is_foreign", "n"])

    n = bags.select("bags", "areas", "given").mapInArrow(run, "item int, is_foreign boolean, n long")
    share = n.groupBy("item").agg(F.sum(F.when(F.col("is_foreign"), F.col("n")).otherwise(0)).alias("f"), F.sum("n").alias("n"))
    return {r["item"]: r["f"] / r["n"] for r in share.where((F.col("f") >= least) & (F.col("f") > 0.6 * F.col("n"))).collect()}


def parts(items: list, size: int = PART) -> list[list]:
    return [items[i : i + size] for i in range(0, len(items), size)]


class Ranked:
    """The items of each sentence that are among ``order``, in that order."""

    def __init__(self, order: list[int], size: int) -> None:
        self.text = [str(i) for i in order]
        self.rank = np.full(size, -1, np.int32)
        self.rank[order] = np.arange(len(order))

    def by_sentence(self, items: np.ndarray, sentence: np.ndarray, sentences: int) -> tuple[list[int], list[str]]:
        """Where each sentence begins among the items (and the end), and the items."""
        rank = self.rank[items]
        at = np.flatnonzero(rank >= 0)
        at = at[np.lexsort((rank[at], sentence[at]))]
        ends = np.cumsum(np.bincount(sentence[at], minlength=sentences))
        return [0, *ends.tolist()], [self.text[r] for r in rank[at].tolist()]


def transactions(bags: DataFrame, leaning: dict[int, tuple[str, float]], context: dict[int, float], size: int, strong: float = 0.75) -> DataFrame:
    """(items): words that lean or context items of each sentence, with the classes =area or
    =foreign. The growth of patterns doubles with every item of a transaction, so sentences with
    many are parted into transactions of PART items, the strongest together; none is left out.
    ``size``: how many items there are."""
    names = Named(leaning, strong, size)
    lean = Ranked(sorted(leaning, key=lambda i: (-leaning[i][1], i)), size)
    near = Ranked(sorted(context, key=lambda i: (-context[i], i)), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sentence_at, document_at = parted(batch.column(0))
            sentence, document = (np.repeat(np.arange(len(x) - 1), np.diff(x)) for x in (sentence_at, document_at))
            areas, given = (c.to_pylist() for c in batch.columns[1:])
            foreign = names.sentences(items, sentence, document, [{*a, *g} for a, g in zip(areas, given)])[1].tolist()
            lean_at, lean_items = lean.by_sentence(items, sentence, len(document))
            near_at, near_items = near.by_sentence(items, sentence, len(document))
            at, buffer = (sentence_at * items.itemsize).tolist(), items.tobytes()
            out: list[list[str]] = []
            for start, end, own in zip(document_at.tolist(), document_at[1:].tolist(), areas):
                told = ["=" + a for a in own if a != REST]
                seen: set[bytes] = set()
                for s in range(start, end):
                    whole = buffer[at[s] : at[s + 1]]
                    # a sentence that a document repeats counts once
                    if lean_at[s] == lean_at[s + 1] or whole in seen:
                        continue
                    seen.add(whole)
                    if near_at[s] < near_at[s + 1]:
                        # words in a foreign context say nothing of the area
                        out += [[*p, "=foreign"] if foreign[s] else p for p in parts(near_items[near_at[s] : near_at[s + 1]])]
                    else:
                        out += [[*p, *told] for p in parts(lean_items[lean_at[s] : lean_at[s + 1]])]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], names=["items"])

    return bags.select("bags", "areas", "given").mapInArrow(run, "items array<string>")


def prune(rules: list[tuple[frozenset, str, float]], gain: float = 0.03) -> list[tuple[frozenset, str, float]]:
    """Rules none of whose more general rules of the same class is about as sure."""
    kept: dict[str, list[tuple[frozenset, float]]] = defaultdict(list)
    out = []
    for k, c, p in sorted(rules, key=lambda r: (len(r[0]), sorted(r[0]), r[1])):
        if not any(g <= k and q >= p - gain for g, q in kept[c]):
            kept[c].append((k, p))
            out.append((k, c, p))
    return out


def weight(p: float) -> float:
    return math.log(p / (1 - p))


def evidenced(bags: DataFrame, rules: Rules) -> DataFrame:
    """(doc_id, given, evidence) of the sample under ``rules``, read once and kept."""
    kind = bags.schema["doc_id"].dataType.simpleString()
    sent = bags.sparkSession.sparkContext.broadcast(rules)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for batch in batches:
            told = [list(matcher.evidence(t).items()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(told, pa.map_(pa.string(), pa.float64()))], names=["doc_id", "given", "evidence"])

    return cut(bags.select("doc_id", "text", "areas").mapInArrow(run, f"doc_id {kind}, given array<string>, evidence map<string,double>"))


def relabelled(bags: DataFrame, seen: DataFrame, rules: Rules) -> DataFrame:
    """``bags`` with the areas that ``rules`` give, wrong and missing labels mended."""
    kind = bags.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [[a for a, _ in areas_of(dict(e), rules)] for e in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.list_(pa.string()))], names=["doc_id", "areas"])

    given = seen.select("doc_id", "evidence").mapInArrow(run, f"doc_id {kind}, areas array<string>")
    return cut(bags.drop("areas", "text").join(given, "doc_id"))


def mine(sample: DataFrame, least: int = MIN_DOCUMENTS) -> Rules:
    """Rules of a labelled sample. As hand-made labels are partly wrong, the sample is first
    relabelled by the words that lean to an area; patterns are grown from these labels, the
    sample is relabelled by the rules found, and patterns and foreign contexts are mined anew.
    All calibration is on the labels as given."""
    bags, names = item_bags(sample, least)
    leaning = leaning_items(item_counts(bags), names, least)
    rules = Rules()
    for item, (area, share) in leaning.items():
        if share >= MIN_SURE:
            rules.areas[frozenset([names[item]])] = [(area, weight(min(share, 0.98)))]
    rules.foreign = [frozenset([names[i]]) for i in foreign_items(bags, leaning, len(names), least=least)]
    for _ in range(2):
        seen = evidenced(bags, rules)
        rules.steps, rules.probabilities = calibrate(seen)
        rules = mined_once(relabelled(bags, seen, rules), names, least)
    rules.steps, rules.probabilities = calibrate(evidenced(bags, rules))
    return rules


def mined_once(bags: DataFrame, names: list[str], least: int = MIN_DOCUMENTS, confidence: float = MIN_CONFIDENCE) -> Rules:
    """Area and foreign rules of a sample with the areas it has now."""
    leaning = leaning_items(item_counts(bags), names, least)
    context = foreign_items(bags, leaning, len(names), least=least)
    held = cut(transactions(bags, leaning, context, len(names)))
    n = held.count()
    rules = Rules()
    if n:
        patterns = FPGrowth(itemsCol="items", minSupport=min(1.0, least / n), numPartitions=max(1, held.sparkSession.sparkContext.defaultParallelism // 2)).fit(held).freqItemsets
        # the sample is bounded, and every partition gets its own copy of the transactions it may grow from
        # a rule is a pattern with one class over the pattern without it: both meet under their words
        is_class = lambda x: x.startswith("=")
        classes, words = F.filter("items", is_class), F.array_sort(F.filter("items", lambda x: ~is_class(x)))
        met = patterns.where((F.size(classes) <= 1) & (F.size(words) > 0)).select(words.alias("words"), F.coalesce(F.get(classes, F.lit(0)), F.lit("")).alias("told"), "freq")
        per = met.groupBy("words").agg(F.max(F.when(F.col("told") == "", F.col("freq"))).alias("n"), F.collect_list(F.when(F.col("told") != "", F.struct("told", "freq"))).alias("told"))
        rows = per.select("words", "n", F.explode("told").alias("t")).where(F.col("t.freq") >= confidence * F.col("n")).select("words", "n", "t.told", "t.freq").collect()
        found = [(frozenset(names[int(i)] for i in r["words"]), r["told"][1:], (r["freq"] + 0.5) / (r["n"] + 1)) for r in rows]
        for k, c, p in prune(found):
            if c == "foreign":
                if p >= 0.7:
                    rules.foreign.append(k)
            elif p >= MIN_SURE:
                rules.areas.setdefault(k, []).append((c, weight(min(p, 0.98))))
    return rules


def calibrate(seen: DataFrame) -> tuple[list[float], list[float]]:
    """A rising step function from evidence to the share of labels that agree (pool adjacent
    violators over the bounded sample)."""
    each = seen.select("given", F.explode("evidence").alias("area", "e"))
    counted = each.groupBy(F.round("e", 1).alias("e")).agg(F.count_if(F.array_contains("given", F.col("area"))).alias("k"), F.count("*").alias("n"))
    blocks: list[list[float]] = []
    for r in counted.orderBy("e").collect():
        blocks.append([r["e"], r["k"], r["n"]])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            e, k, n = blocks.pop()
            blocks[-1][1] += k
            blocks[-1][2] += n
    return [b[0] for b in blocks], [b[1] / b[2] for b in blocks]


def areas_of(evidence: dict[str, float], rules: Rules, least: float = 0.5) -> list[tuple[str, float]]:
    """One to three areas with their probabilities, or the rest alone."""
    sure = sorted(((-rules.probability(e), -e, a) for a, e in evidence.items()))
    told = [(a, -p) for p, _, a in sure if -p >= least][:MOST_AREAS]
    return told or [(REST, 1.0 - max((-p for p, _, _ in sure), default=0.0))]


def assign(docs: DataFrame, rules: Rules, key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, keep, area, probability), one row per document and area. A null or empty text,
    and one in which no rule matches, has the area ``procedure`` alone."""
    columns = [key, *keep]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns] + ["area string", "probability double"])
    sent = docs.sparkSession.sparkContext.broadcast(rules)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for batch in batches:
            at, areas, probabilities = [], [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                for a, p in areas_of(matcher.evidence(text) if text else {}, sent.value):
                    at.append(i)
                    areas.append(a)
                    probabilities.append(p)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns[:-1]), pa.array(areas, pa.string()), pa.array(probabilities, pa.float64())], names=[*columns, "area", "probability"])

    return docs.select(*columns, F.col("text").alias("__text")).mapInArrow(run, schema)


def composition(assigned: DataFrame, key: str = "doc_id", size: str = "n_chars") -> DataFrame:
    """Documents and size by area; a document of several areas counts to each in equal parts."""
    per = assigned.groupBy(key).agg(F.count("*").alias("_areas"))
    each = assigned.join(per, key)
    part = F.lit(1.0) / F.col("_areas")
    whole = each.groupBy("area").agg(F.count("*").alias("documents"), F.sum(part).alias("document_parts"), F.sum(part * F.coalesce(F.col(size), F.lit(0))).alias("size_parts"))
    total = whole.agg(F.sum("document_parts").alias("_d"), F.sum("size_parts").alias("_s"))
    return whole.crossJoin(F.broadcast(total)).select("area", "documents", (F.col("document_parts") / F.col("_d")).alias("document_share"), (F.col("size_parts") / F.greatest("_s", F.lit(1.0))).alias("size_share"))  # one row
