"""Operator 6: toxicity by weak supervision.

Voters say yes or stay silent on each document: word lists, phrases, and word and word-start lists mined from a bounded sample of
labelled documents.  A generative label model, fitted to the counts of all vote patterns of the whole corpus, estimates the voters'
accuracies and correlations.  Its posterior of each pattern labels a bounded sample of documents, on
which a linear classifier over words and word starts is trained.  The classifier scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import NOT_LETTERS, grams, prefixes, slices, text_bytes, words, words_at

# Word lists of the voters, by kind of insult, in the four languages of the corpus.
LEXICONS = {
    "mind": "idiot idiots moron morons stupid imbecile imbeciles dumb dimwit idiote idiotes stupide débile crétin imbécile idiota idiotas estúpido estúpida imbécil trottel dummkopf blödmann",
    "worth": "worthless useless pathetic loser losers inutile pathétique minable perdedor inútil patético wertlos nutzlos versager erbärmlich",
    "disgust": "disgusting filthy repulsive vile revolting dégoûtant répugnant asqueroso repugnante widerlich ekelhaft",
    "refuse": "trash garbage scum vermin ordure racaille basura escoria abschaum müll",
    "ridicule": "clown clowns buffoon laughingstock bouffon payaso hampelmann",
    "hate": "hate despise loathe détester odiar verachten hasse",
}
# Phrases of two words.
PHRASES = "shut up;drop dead;go away;you idiot;you moron;you loser;you clown;hate you;kill yourself;so stupid;ferme la;cállate ya;halt maul"
#: Bytes of the word starts; 0 is the whole word.
STARTS = (0, 4, 5, 6, 8)
VOTERS = len(LEXICONS) + 1 + len(STARTS)

#: Bounds of the samples: labelled documents that lists are mined from; documents with and without votes that train the classifier.
MINED_DOCUMENTS = 6_000
SAMPLE_VOTED, SAMPLE_SILENT = 3_000, 5_000
_MINED_PRECISION = 0.85
KINDS_TOXIC, KINDS_OTHER = 6, 2
_STEPS, _RATE, _DECAY = 200, 0.3, 1e-5


def _hashes(text: str) -> np.ndarray:
    return words(pa.array([text]), NOT_LETTERS)[0]


_LEXICON_HASHES = [np.sort(_hashes(v)) for v in LEXICONS.values()]
_PHRASE_HASHES = np.sort(np.concatenate([grams(_hashes(p), 2) for p in PHRASES.split(";")]))


class Members:
    """Place of hashes in a list; most are ruled out by 20 of their bits before the list is searched."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.cells = np.zeros(1 << 20, bool)
        self.cells[self._cell(self.hashes)] = True

    @staticmethod
    def _cell(hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.asarray((1 << 20) - 1, hashes.dtype)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the list, and where in it."""
        maybe = np.flatnonzero(self.cells[self._cell(hashes)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        real = self.hashes[at] == hashes[maybe]
        return maybe[real], at[real]


class Terms:
    """Words and word starts of a slice of texts: for each of ``STARTS`` the 32-bit hashes and the text each is from."""

    def __init__(self, column: pa.Array):
        self.count = len(column)
        data, _ = text_bytes(column)
        self.words, offsets, begin, end = words_at(column, NOT_LETTERS)
        self.owner = np.repeat(np.arange(self.count), np.diff(offsets))
        self.kinds: list[tuple[np.ndarray, np.ndarray]] = []
        for size in STARTS:
            hashes, which = prefixes(data, begin, end, size) if size else (self.words, slice(None))
            self.kinds.append(((hashes >> np.uint64(32)).astype(np.uint32), self.owner[which]))

    def distinct(self) -> list[np.ndarray]:
        """The distinct hashes of each text, of all kinds together."""
        owner = np.concatenate([o for _, o in self.kinds])
        both = np.unique((owner.astype(np.uint64) << np.uint64(32)) | np.concatenate([h for h, _ in self.kinds]))
        return np.split((both & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.searchsorted(both, np.arange(1, self.count, dtype=np.uint64) << np.uint64(32)))


class Voters:
    """The fixed lists and the mined ones; one bit a voter."""

    def __init__(self, mined: list[np.ndarray]):
        self.mined = [Members(m) for m in mined]
        self.fixed = [Members(m) for m in _LEXICON_HASHES]
        self.phrases = Members(_PHRASE_HASHES)

    def vote(self, terms: Terms) -> np.ndarray:
        out = np.zeros(terms.count, np.int64)

        def yes(bit: int, owners: np.ndarray) -> None:
            out[np.bincount(owners, minlength=terms.count) > 0] |= 1 << bit

        for bit, members in enumerate(self.fixed):
            yes(bit, terms.owner[members.find(terms.words)[0]])
        at = self.phrases.find(grams(terms.words, 2))[0]
        yes(len(self.fixed), terms.owner[at[terms.owner[at] == terms.owner[at + 1]]])
        for k, members in enumerate(self.mined):
            hashes, owner = terms.kinds[k]
            yes(len(self.fixed) + 1 + k, owner[members.find(hashes)[0]])
        return out


def _term_counts(lists: list[np.ndarray], positive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of some texts, and in how many texts of either label each is."""
    term, own = np.unique(np.concatenate([*lists, np.zeros(0, np.uint32)]), return_inverse=True)
    label = np.repeat(positive, [len(x) for x in lists])
    yes = np.bincount(own, label, len(term))
    return term, yes, np.bincount(own, minlength=len(term)) - yes


def _one_label(labels: DataFrame) -> DataFrame:
    return labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))


def mine(documents: DataFrame, labels: DataFrame) -> list[np.ndarray]:
    """For each of ``STARTS``, hashes of the words or word starts that labelled toxic documents have and others hardly do.

    From about ``MINED_DOCUMENTS`` rows of ``labels`` (doc_id, label), chosen by a hash of doc_id.
    """
    known = _one_label(labels)
    share = min(1.0, MINED_DOCUMENTS / max(1, known.count()))
    chosen = known.filter(F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5 <= share).limit(2 * MINED_DOCUMENTS)
    rows = documents.join(F.broadcast(chosen), "doc_id").select("label", "text").mapInArrow(_kind_rows, "label int, kinds array<binary>").limit(2 * MINED_DOCUMENTS).collect()
    positive = np.array([r.label for r in rows], float)
    out = []
    for k in range(len(STARTS)):
        lists = [np.frombuffer(bytes(r.kinds[k]), np.uint32) for r in rows]
        term, yes, no = _term_counts(lists, positive)
        # kept: terms that are nearly always toxic, and too often for chance among so many terms
        base, rate = np.clip(positive.mean(), 1e-6, 1 - 1e-6) if len(rows) else 0.5, np.clip(yes / np.maximum(1, yes + no), 1e-6, 1 - 1e-6)
        surprise = yes * np.log(rate / base) + no * np.log((1 - rate) / (1 - base))
        out.append(term[(rate >= _MINED_PRECISION) & (surprise > np.log(len(term) + 1) + 3)])
    return out


def _kind_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        terms = Terms(batch.column("text"))
        own = [[] for _ in range(terms.count)]
        for hashes, owner in terms.kinds:
            both = np.unique((owner.astype(np.uint64) << np.uint64(32)) | hashes)
            ends = np.searchsorted(both, np.arange(terms.count + 1, dtype=np.uint64) << np.uint64(32))
            for i in range(terms.count):
                own[i].append((both[ends[i] : ends[i + 1]] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(own, pa.list_(pa.binary()))], ["label", "kinds"])


class LabelModel:
    """Generative model of vote patterns, fitted by expectation maximisation on counts.

    Toxic documents are of ``KINDS_TOXIC`` hidden kinds and others of ``KINDS_OTHER``, each with a rate for each voter; kinds with
    different rates make voters agree more or less often than by chance, so they carry the voters' correlations.  Patterns of
    labelled documents stay on their side; those of all other documents are free.  ``rates`` has, by voter, the
    rate on either side, which is the voter's accuracy.
    """

    def __init__(self, counts: dict[tuple[int, int | None], int], rounds: int = 300):
        keys = sorted(counts, key=lambda x: (x[0], -1 if x[1] is None else x[1]))
        self.codes = np.array([c for c, _ in keys], np.int64)
        count = np.array([counts[k] for k in keys], float)
        bits = ((self.codes[:, None] >> np.arange(VOTERS)) & 1).astype(float)
        toxic = np.arange(KINDS_OTHER + KINDS_TOXIC) >= KINDS_OTHER
        allowed = np.array([[label is None or bool(label) == t for t in toxic] for _, label in keys]).reshape(len(keys), len(toxic))
        r = np.random.default_rng(3)
        start = r.uniform(0.5, 1.5, allowed.shape) * np.where(toxic[None, :] == (bits.sum(axis=1) > 0)[:, None], 1.0, 0.05)
        share = np.where(allowed, start, 0)
        for _ in range(rounds):
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            mass = share * count[:, None]
            size = mass.sum(axis=0)
            prior = (size + 0.1) / (size + 0.1).sum()
            rate = (mass.T @ bits + 0.01) / (size[:, None] + 1.0)
            odds = np.log(prior) + bits @ np.log(rate.T) + (1 - bits) @ np.log1p(-rate.T)
            odds = np.where(allowed, odds, -np.inf)
            share = np.exp(odds - odds.max(axis=1, keepdims=True))
        free = np.log(prior) + bits @ np.log(rate.T) + (1 - bits) @ np.log1p(-rate.T)
        free = np.exp(free - free.max(axis=1, keepdims=True))
        self.post = free[:, toxic].sum(axis=1) / free.sum(axis=1)
        side = [prior[~toxic] / prior[~toxic].sum(), prior[toxic] / prior[toxic].sum()]
        self.rates = np.stack([side[0] @ rate[~toxic], side[1] @ rate[toxic]], axis=1)

    def posterior(self) -> dict[int, float]:
        """Chance of each pattern to be toxic, labels aside."""
        return dict(zip(self.codes.tolist(), self.post.tolist(), strict=True))


class LinearModel:
    """Logistic regression on the presence of words and word starts."""

    def __init__(self):
        self.terms, self.weights, self.bias = Members(np.zeros(0, np.uint32)), np.zeros(0), -4.0

    def fit(self, lists: list[np.ndarray], soft: np.ndarray) -> LinearModel:
        hard = (soft > 0.5).astype(float)
        term, yes, no = _term_counts(lists, hard)
        n1, n0 = max(1.0, hard.sum()), max(1.0, (1 - hard).sum())
        often = yes + no >= max(3, 0.0005 * len(lists))
        # only terms that toxic documents have more often than by chance: what else a text says does not excuse it
        p = (yes + no + 1) / (n1 + n0 + 2)
        far = (yes / n1 - no / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
        self.terms = Members(term[often & (far > 4)])
        owner, column = [], []
        for i, own in enumerate(lists):
            at = self.terms.find(own)[1]
            owner.append(np.full(len(at), i))
            column.append(at)
        owner, column = np.concatenate(owner), np.concatenate(column)
        balance = np.where(hard > 0, 0.5 / n1, 0.5 / n0)
        size = len(self.terms.hashes)
        w, m, s = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
        for step in range(1, _STEPS + 1):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, w[column], len(soft)) + w[-1], -30, 30)))
            d = (p - soft) * balance
            slope = np.append(np.bincount(column, d[owner], size), d.sum())
            slope[:-1] += _DECAY * w[:-1]
            m += 0.1 * (slope - m)
            s += 0.001 * (slope * slope - s)
            w -= _RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-6)
        self.weights, self.bias = w[:-1], float(w[-1])
        return self

    def score(self, terms: Terms) -> np.ndarray:
        owner, column = [], []
        for hashes, own in terms.kinds:
            which, at = self.terms.find(hashes)
            owner.append(own[which])
            column.append(at)
        size = max(1, len(self.weights))
        both = np.unique(np.concatenate(owner).astype(np.int64) * size + np.concatenate(column).astype(np.int64))
        total = np.bincount(both // size, self.weights[both % size] if len(both) else None, terms.count) if len(both) else np.zeros(terms.count)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def train(documents: DataFrame, labels: DataFrame) -> tuple[LabelModel, LinearModel]:
    """Label model of the votes on all ``documents`` (doc_id, text), and the classifier of a sample chosen by a hash of doc_id and text."""
    broadcast = documents.sparkSession.sparkContext.broadcast
    voters = broadcast(Voters(mine(documents, labels)))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            votes = voters.value.vote(Terms(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes)], ["doc_id", "pattern"])

    votes = documents.mapInArrow(vote, "doc_id long, pattern long")
    rows = votes.join(_one_label(labels), "doc_id", "left").groupBy("pattern", "label").count().collect()  # 3 * 2^VOTERS rows at most
    label_model, linear = LabelModel({(r["pattern"], r["label"]): r["count"] for r in rows}), LinearModel()
    total = {k: sum(r["count"] for r in rows if (r["pattern"] > 0) == k) for k in (True, False)}
    share = {k: min(1.0, n / max(1, total[k])) for k, n in ((True, SAMPLE_VOTED), (False, SAMPLE_SILENT))}

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            terms, place = Terms(batch.column("text")), batch.column("place").to_numpy()
            votes = voters.value.vote(terms)
            chosen = np.flatnonzero(np.where(votes > 0, place <= share[True], place <= share[False]))
            lists = terms.distinct()
            yield pa.RecordBatch.from_arrays([pa.array(votes[chosen]), pa.array([lists[i].tobytes() for i in chosen], pa.binary())], ["pattern", "terms"])

    place = F.xxhash64("doc_id", "text").cast("double") / 2.0**64 + 0.5
    near = documents.select(place.alias("place"), "text").filter(F.col("place") <= max(share.values()))
    found = near.mapInArrow(sample, "pattern long, terms binary").limit(2 * (SAMPLE_VOTED + SAMPLE_SILENT)).collect()
    found.sort(key=lambda r: (r.pattern, bytes(r.terms)))
    if found:
        post = label_model.posterior()
        linear.fit([np.frombuffer(bytes(r.terms), np.uint32) for r in found], np.array([post[r.pattern] for r in found]))
    return label_model, linear


def score_toxicity(documents: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """(doc_id, score) for each row of ``documents`` (doc_id, text): the chance, 0 to 1, that the text is toxic.

    Labels (doc_id, label 0 or 1) are used only where ``learn_from`` holds of them, to mine voters' lists and to anchor the label model; a doc_id labelled twice
    counts as 1 if either label is.  Null and empty texts have no words and get the classifier's score of none; repeated rows are scored alike.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = documents.sparkSession.sparkContext.broadcast(train(docs, labels.filter(learn_from))[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(Terms(batch.column("text"))))], ["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")
