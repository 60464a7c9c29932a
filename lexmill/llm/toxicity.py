"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Folding: letters are lower-cased, accents dropped, homoglyphs and digit or sign substitutions read as
the letters they imitate, everything else becomes a space.  The lexicon holds word starts with a log-odds weight, learned
from a bounded sample of labelled documents (``sample`` rows, smallest hashes first), plus entries that the caller
gives.  Entries match at word starts only.  Exception phrases (given, and words or word pairs learned from the same sample: those
around matches in documents labelled clean that documents labelled toxic hardly hold; words of up to 40 letters) cancel the
matches inside them.  A document's features are its summed weight and that weight over the
square root of its length in words; a logistic curve over both, fitted on the same sample, gives the score.

Texts of any length are read whole.  Defined results: a null text is an empty text and gets the score of a text without matches; without labels the
learned lexicon is empty and only given entries count; repeated rows get equal scores; an empty table gives an
empty result; labels that contradict each other or repeat for one doc_id count each; columns other than doc_id and text are
ignored, or with ``keep`` passed through (``score`` is written anew).
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Signs that imitate Latin letters, beside accented letters, which the rule in ``_table`` covers.
IMITATIONS = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
SHORTEST, LONGEST = 4, 12
#: Rows whose texts a task holds as strings at a time.
SLICE = 500


def _table() -> dict[int, str]:
    """Translation of Latin, Greek and Cyrillic code points to folded letters; other signs become spaces."""
    table: dict[int, str] = {}
    letters = [*range(0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), *range(0x2100, 0x2150), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]
    for code in letters:
        ch = chr(code)
        low = unicodedata.normalize("NFKD", ch.lower())
        base = "".join(c for c in low if not unicodedata.combining(c)) or " "
        base = "".join(IMITATIONS.get(c, c) for c in base)
        table[code] = base if base.isalnum() else IMITATIONS.get(ch, " ")
    for code in [*range(0x2000, 0x2070), *range(0x3000, 0x3004)]:
        table[code] = " "
    for code in [0xAD, *range(0x300, 0x370), *range(0x200B, 0x2010), *range(0x2060, 0x2065), *range(0xFE00, 0xFE10), 0xFEFF]:
        table[code] = ""  # signs without width and combining marks part no word
    return table


FOLD = _table()
#: Signs at a word's end are punctuation, not letters.
_ENDS = str.maketrans({c: " " for c in "!|"})


def fold(text: str) -> str:
    """Folded text, a space before and after every word."""
    if "!" in text or "|" in text:
        words = text.split()
        text = " ".join([w.rstrip("!|") if w[-1:] in "!|" else w for w in words])
    return " " + " ".join(text.translate(FOLD).split()) + " "


def starts(text: str) -> set[str]:
    """Word starts of a folded text, whole words with a closing space included."""
    out = set()
    for w in set(text.split()):
        out.update(w[:n] for n in range(SHORTEST, min(len(w), LONGEST) + 1))
        if len(w) >= SHORTEST - 1:
            out.add(w + " ")
    return out


def pick_lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int, least: int) -> dict[str, float]:
    """Entries with clear log-odds; a longer entry is left out if a start of it is as telling."""
    kept: dict[str, float] = {}
    for entry, a, b in counts:
        if a < least:
            continue
        odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if odds >= 2.0 and a / (a + b) >= 0.8:
            kept[entry] = odds
    lean = {e: w for e, w in kept.items() if not any(e[:n] in kept and kept[e[:n]] >= w - 0.5 for n in range(SHORTEST, len(e)))}
    return dict(sorted(lean.items(), key=lambda x: (-x[1], x[0])))


def pick_exceptions(counts: list[tuple[str, int, int]], toxic: int, clean: int, least: int) -> list[str]:
    """Phrases around matches that tell a clean document; toxic, clean: documents with matches."""
    kept: dict[str, float] = {}
    for phrase, a, b in counts:
        if b < least:
            continue
        odds = math.log((b + 0.5) / (clean + 1)) - math.log((a + 0.5) / (toxic + 1))
        if odds >= 2.0 and b / (a + b) >= 0.8:
            kept[phrase] = odds
    return sorted(kept, key=lambda x: (-kept[x], x))


class Matcher:
    """Aho-Corasick automaton of entries (at word starts) and exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str]):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        self.any = False
        for entry, weight in lexicon.items():
            if entry.strip():
                self.auto.add_word(" " + entry, (len(entry) + 1, weight))
                self.any = True
        for phrase in exceptions:
            folded = fold(phrase)
            if folded.strip():
                self.auto.add_word(folded, (len(folded), None))
                self.any = True
        if self.any:
            self.auto.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(first place, last place, weight) of the matches that no exception phrase holds."""
        hits, spans = [], []
        for end, (length, weight) in self.auto.iter(folded):
            (spans if weight is None else hits).append((end - length + 1, end, weight))
        if spans:
            spans.sort(key=lambda x: x[0])
            at = [s for s, _, _ in spans]
            far = list(accumulate((e for _, e, _ in spans), max))  # the furthest end of the spans up to each
            hits = [h for h in hits if not (i := bisect_right(at, h[0])) or far[i - 1] < h[1]]
        return hits

    def contexts(self, text: str) -> set[str]:
        """Words with matches, alone and with the word before and after."""
        folded, out = fold(text), set()
        if not self.any or not folded.strip():
            return out
        for at, end, _ in self.hits(folded):
            stop = folded.index(" ", end)
            word = folded[at + 1 : stop]
            before = folded[folded.rfind(" ", 0, at) + 1 : at]
            after = folded[stop + 1 : max(folded.find(" ", stop + 1), stop + 1)]
            if len(word) <= 40:
                out.add(word)
                out.update(f"{a} {b}" for a, b in ((before, word), (word, after)) if 0 < len(a) <= 40 and 0 < len(b) <= 40)
        return out

    def features(self, text: str) -> tuple[float, float]:
        """(summed weight, weight over the square root of the number of words)."""
        folded = fold(text)
        n = folded.count(" ") - 1
        if not self.any or n <= 0:
            return 0.0, 0.0
        best: dict[int, float] = {}
        for at, _, w in self.hits(folded):  # a word counts once, by its heaviest entry
            best[at] = max(best.get(at, w), w)
        total = sum(best.values())
        return total, total / math.sqrt(n)


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Logistic regression with a light ridge, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 20_000,
    least: int = 4,
    given: dict[str, float] | None = None,
    exceptions: tuple[str, ...] = (),
) -> dict:
    """Lexicon, exceptions and curve from labelled documents (labels: doc_id, toxic)."""
    chosen = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)  # at most `sample` rows of 12 bytes
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    def count(batches, of=lambda text: starts(fold(text))):
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                toxic, clean = Counter(), Counter()
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    (toxic if label else clean).update(of(text or ""))
                if toxic or clean:
                    keys = list({**toxic, **clean})
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], ["entry", "a", "b"])

    n = {r[0]: r[1] for r in texts.groupBy("toxic").count().collect()}
    toxic, clean = sum(v for k, v in n.items() if k), n.get(0, 0)
    counts = texts.mapInArrow(count, "entry string, a long, b long").groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # what the sample's words can tell, all of it: an entry is in `least` toxic documents of the sample or more
    telling = counts.where(F.col("a") >= least).where("a >= 4 * b").collect()
    lexicon = pick_lexicon([tuple(r) for r in telling], toxic, clean, least) | (given or {})
    bound = {"lexicon": lexicon, "exceptions": list(exceptions)}

    def around(batches):
        m = matcher_of(bound)
        # the empty phrase counts the documents with matches
        yield from count(batches, lambda text: {"", *found} if (found := m.contexts(text)) else found)

    if lexicon and toxic and clean:
        near = texts.mapInArrow(around, "entry string, a long, b long").groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("b") >= least).where("b >= 4 * a or entry = ''")
        near = {r[0]: (r[0], r[1], r[2]) for r in near.collect()}
        if "" in near:
            _, of_toxic, of_clean = near.pop("")
            learned = pick_exceptions(list(near.values()), of_toxic, of_clean, least)
            bound = bound | {"exceptions": [*exceptions, *learned]}
    matcher = Matcher(lexicon, bound["exceptions"])

    def measure(batches):
        m = matcher_of(bound)
        for b in batches:
            f = [m.features(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in f], pa.float64()), pa.array([x[1] for x in f], pa.float64()), b.column(1)], ["s", "d", "toxic"])

    curve = np.array([-4.0, 1.0, 0.0])
    if matcher.any and toxic and clean:
        got = texts.mapInArrow(measure, "s double, d double, toxic int").toPandas()  # at most `sample` rows
        curve = fit_curve(got[["s", "d"]].to_numpy(), (got["toxic"] > 0).to_numpy(float))
    elif toxic or clean:
        curve = np.array([math.log((toxic + 0.5) / (clean + 0.5)), 0.0, 0.0])
    return bound | {"curve": curve.tolist()}


_MATCHERS: dict[int, tuple] = {}


def matcher_of(model: dict) -> Matcher:
    key = hash((tuple(sorted(model["lexicon"].items())), tuple(model["exceptions"])))
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = (Matcher(model["lexicon"], model["exceptions"]),)
    return _MATCHERS[key][0]


def score(docs: DataFrame, model: dict, keep: bool = False) -> DataFrame:
    """doc_id and score of every document; ``keep`` returns the input's own columns plus ``score``."""
    curve = model["curve"]

    def work(batches):
        m = matcher_of(model)
        for b in batches:
            at = b.schema.get_field_index("text")
            f: list[tuple[float, float]] = []
            for i in range(0, b.num_rows, SLICE):
                f += [m.features(t or "") for t in b.column(at).slice(i, SLICE).cast(pa.string()).to_pylist()]
            s = pa.array([1 / (1 + math.exp(-max(-30.0, min(30.0, curve[0] + curve[1] * x + curve[2] * y)))) for x, y in f], pa.float64())
            keeps = [i for i in range(b.num_columns) if keep or i != at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keeps), s], [*(b.schema.names[i] for i in keeps), "score"])

    rows = docs.drop("score") if keep else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = rows.drop("" if keep else "text").schema.add("score", "double")  # of a frame of its own: add() changes it
    return rows.mapInArrow(work, schema)


def fold_of(doc_id):
    """Remainder of the crc32 of the id's text by 5; rows without id are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Learn from rows outside the held-out fold and score all: doc_id, held_out, score, predicted."""
    model = learn(spark, docs, labels.where(fold_of(F.col("doc_id").cast("long")) != 0), **options)
    out = score(docs, model)
    held = F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
