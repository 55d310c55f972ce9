"""Language identification of mixed-language text (operator 3).

Model. From labelled texts: for each language, counts of hashed character n-grams (1 to 4, with word edges) and
of whole words, and the share of its words in each script. Fitted on a sample of about `fit_docs` labelled rows
for each language, chosen by a hash of doc_id (a documented bound; all else runs over all rows and whole texts). Labels
beyond the MOST_LANGS most frequent ones are not learned, so that thousands of junk labels don't make the model grow.

Prediction. Words are runs of letters. The *script ranges* of a word's first letter narrow the candidate
languages to those that write in that script. Each word gets a log probability per candidate from its n-grams;
a *Viterbi* pass with a penalty for each switch of language labels the words, and runs of one label are spans.
All texts of a batch step through the Viterbi recursion side by side, so numpy does the work.
The text's language has the most letters in its spans; the score is that share of the letters.

Cases: a null text, or one without letters, is `und` with score 0; a text whose scripts no learned language uses
gets the most frequent learned language with score 0; rows without a label, doc_id or text are not learned from;
ties go to the language with more learned rows, then by name. With no labelled row at all everything is `und`.
Repeated rows give repeated results, an empty table an empty result; extra columns are ignored. Number signs such as a
circled one are no letters. A very long text is one row of one task, one step of the recursion for each word (about 12
seconds for a million words).
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, slices, text_slices

FIT_DOCS = 4000          # labelled rows per language the model is fitted on, about
MOST_LANGS = 128         # languages that are learned at most: the model is 33 MB then
BUCKETS = 1 << 16        # hashed n-gram features
SWITCH_PENALTY = 8.0     # log cost of changing the language between two words
WORD_FLOOR = -5.0        # no word counts more than this against a language
SCRIPT_SHARE = 0.01      # a language writes in a script if this share of its words does
BATCH_CHARS = 5_000_000  # code points of text a task works on at once
WORDS_AT_ONCE = 20_000   # distinct words whose n-grams are held at once
UNKNOWN = "und"

LETTERS = re.compile(r"[^\W\d_]+")
# word characters that are neither letters (Unicode category L) nor digits: fractions, circled numbers and the like
_NUMBERS = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not (c.isalpha() or c.isdecimal())]
_SIGNS = re.compile("[" + "".join(c for c in _NUMBERS if c <= "\uffff") + "]")       # sets of these alone are fast
_RARE_SIGNS = re.compile("[" + "".join(c for c in _NUMBERS if c > "\uffff") + "]")
_RARE = re.compile("[\U00010000-\U0010ffff]")

# First code point of each script block used to narrow candidates (Unicode blocks).
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "lao"),
           (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
           (0x1380, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
           (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"),
           (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
           (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
           (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han")]
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT_OF = np.array([_NAMES.index(n) for _, n in SCRIPTS])


def lowered(text: str) -> str:
    """The text in small letters, in which LETTERS finds runs of letters only; every code point keeps its place."""
    text = text.lower()
    if text.isascii():
        return text
    if _RARE.search(text):
        text = _RARE_SIGNS.sub(" ", text)
    return _SIGNS.sub(" ", text)


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, feature bucket) of every n-gram of every word, and each word's script."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    first = np.flatnonzero(cp == 2)
    of = np.cumsum(cp == 2) - 1
    script = _SCRIPT_OF[np.searchsorted(_STARTS, cp[first + 1], side="right") - 1]
    mult = np.uint64(0x9E3779B97F4A7C15)
    ids, feats = [], []
    h = np.zeros(len(cp), dtype=np.uint64)
    for n in range(1, 5):
        m = len(cp) - n + 1
        if m <= 0:
            break
        h = (h[:m] * np.uint64(0x100000001B3)) ^ ((cp[n - 1:] + np.uint64(n)) * mult)
        ok = of[:m] == of[n - 1:]
        if n == 1:
            ok &= (cp > 3)
        x = h[ok]
        feats.append((((x ^ (x >> np.uint64(29))) * mult) >> np.uint64(48)).astype(np.int32))
        ids.append(of[:m][ok])
    # the whole word as one more feature: a polynomial over its code points
    power = (cp + np.uint64(7)) * mult
    power ^= power >> np.uint64(31)
    pos = np.arange(len(cp), dtype=np.uint64) - first[of].astype(np.uint64)
    sums = np.add.reduceat(power * (pos * np.uint64(2) + np.uint64(1)), first)
    feats.append(((sums * mult) >> np.uint64(48)).astype(np.int32))
    ids.append(np.arange(len(words)))
    return np.concatenate(ids), np.concatenate(feats), script


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS) -> dict:
    """The model: languages by falling number of rows, log probabilities of features, scripts of each language.

    What comes to the driver is bounded by BUCKETS counts for each language, whatever the number of rows.
    """
    rows = labelled.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect()}
    langs = sorted(seen, key=lambda k: (-seen[k], k))
    if not langs:
        return {"langs": [], "logp": None, "scripts": None}
    # every labelled row has the same chance within its language: hash of doc_id below the language's share
    share = F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, fit_docs / seen[k]))]), F.col("lang"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    number = {k: i for i, k in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BUCKETS + len(_NAMES)), dtype=np.int64)
        for b in batches:
            texts, own = b.column("text").to_pylist(), b.column("lang").to_pylist()
            for lo, hi in slices(texts, BATCH_CHARS // 4):
                by: dict[int, list[str]] = {}
                for t, k in zip(texts[lo:hi], own[lo:hi]):
                    by.setdefault(number[k], []).extend(LETTERS.findall(lowered(t)))
                for i, words in by.items():
                    for at in range(0, len(words), WORDS_AT_ONCE):
                        _, f, script = _features(words[at:at + WORDS_AT_ONCE])
                        total[i, :BUCKETS] += np.bincount(f, minlength=BUCKETS)
                        total[i, BUCKETS:] += np.bincount(script, minlength=len(_NAMES))
        i, f = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(f.astype(np.int32)),
                                          pa.array(total[i, f])], names=["l", "f", "n"])

    counts = (rows.where(F.col("lang").isin(langs) & (place < share)).mapInArrow(lean(count), "l int, f int, n long")
              .groupBy("l", "f").agg(F.sum("n").alias("n")).toPandas())
    table = np.zeros((len(langs), BUCKETS + len(_NAMES)))
    table[counts["l"], counts["f"]] = counts["n"]
    grams, scripts = table[:, :BUCKETS] + 0.5, table[:, BUCKETS:]
    logp = np.log(grams / grams.sum(axis=1, keepdims=True)).T
    logp -= logp.mean(axis=1, keepdims=True)
    writes = (scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= SCRIPT_SHARE).T
    return {"langs": langs, "logp": logp.astype(np.float32), "scripts": writes}


def _word_scores(words: list[str], model: dict) -> np.ndarray:
    """Log probability of each language for each distinct word, floored; a language of another script gets the
    floor twice, a word in a script that no language writes gets zeros."""
    out = np.empty((len(words), len(model["langs"])), dtype=np.float32)
    for lo in range(0, len(words), WORDS_AT_ONCE):
        part = words[lo:lo + WORDS_AT_ONCE]
        ids, feats, script = _features(part)
        s = np.stack([np.bincount(ids, weights=col[feats], minlength=len(part)) for col in model["logp"].T], axis=1) / 2.0
        top = s.max(axis=1, keepdims=True)
        s = s - (top + np.log(np.exp(s - top).sum(axis=1, keepdims=True)))
        s = np.maximum(s, WORD_FLOOR)
        can = model["scripts"][script]
        s = np.where(can, s, 2 * WORD_FLOOR)
        s[~can.any(axis=1)] = 0.0
        out[lo:lo + len(part)] = s
    return out


def _viterbi(scores: np.ndarray, index: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word; texts lie one after another in index (word -> row of scores)."""
    k = scores.shape[1]
    labels = np.zeros(len(index), dtype=np.int16)
    if k == 1 or not len(index):
        return labels
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    offs, lens = starts[order], lengths[order]
    steps = int(lens[0])
    alive = np.searchsorted(-lens, -np.arange(steps), side="left")   # texts with more than t words
    delta = scores[index[offs[:alive[0]]]].astype(np.float64)
    stay = np.empty((len(index), k), dtype=bool)
    frm = np.empty(len(index), dtype=np.int16)
    final = np.zeros(len(offs), dtype=np.int16)
    for t in range(1, steps):
        n = alive[t]
        if n < len(delta):
            final[n:len(delta)] = delta[n:].argmax(axis=1)
            delta = delta[:n]
        at = offs[:n] + t
        best = delta.argmax(axis=1)
        moved = delta[np.arange(n), best][:, None] - penalty
        keep = delta >= moved
        stay[at], frm[at] = keep, best
        delta = np.where(keep, delta, moved) + scores[index[at]]
    final[:len(delta)] = delta.argmax(axis=1)
    now = final
    for t in range(steps - 1, 0, -1):
        n = alive[t]
        at = offs[:n] + t
        labels[at] = now[:n]
        now[:n] = np.where(stay[at, now[:n]], now[:n], frm[at])
    live = alive[0]
    labels[offs[:live]] = now[:live]
    return labels


def _predict(texts: list[str | None], model: dict, penalty: float) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text."""
    langs = model["langs"]
    number: dict[str, int] = {}
    index: list[int] = []
    lengths = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        words = LETTERS.findall(lowered(t)) if t else []
        lengths[i] = len(words)
        index.extend([number.setdefault(w, len(number)) for w in words])
    if not index or not langs:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    distinct = list(number)
    scores = _word_scores(distinct, model)
    known = scores.any(axis=1)
    letters = np.fromiter(map(len, distinct), dtype=np.int64, count=len(distinct))
    idx = np.array(index, dtype=np.int64)
    labels = _viterbi(scores, idx, lengths, penalty)
    of = np.repeat(np.arange(len(texts)), lengths)
    size = letters[idx]
    by = np.zeros((len(texts), len(langs)))
    np.add.at(by, (of, labels), size * known[idx])
    total = np.bincount(of, weights=size, minlength=len(texts))
    best = by.argmax(axis=1)
    score = by[np.arange(len(texts)), best] / np.maximum(total, 1)
    ends = np.cumsum(lengths)
    out = []
    for i, t in enumerate(texts):
        if not lengths[i]:
            out.append((UNKNOWN, 0.0, []))
            continue
        own = labels[ends[i] - lengths[i]:ends[i]]
        turns = np.flatnonzero(np.diff(own)) + 1
        if len(turns):   # only then the places of the words inside the text are needed
            found = [m.span() for m in LETTERS.finditer(lowered(t))]
            cuts = [0, *turns.tolist(), len(own)]
            spans = [{"lang": langs[own[a]], "first": found[a][0], "last": found[b - 1][1]} for a, b in zip(cuts, cuts[1:])]
        else:
            spans = [{"lang": langs[own[0]], "first": 0, "last": len(t)}]
        out.append((langs[best[i]], float(min(1.0, score[i])), spans))
    return out


_OUT = pa.schema([("doc_id", pa.int64()), ("held", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
                  ("spans", pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64())])))])


def identify(docs: DataFrame, model: dict, penalty: float = SWITCH_PENALTY, held: Column | None = None) -> DataFrame:
    """doc_id, held, lang_pred, score and spans (language, first and last code point of the lower-cased text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, texts in text_slices(b.column("text"), BATCH_CHARS):
                lang, score, spans = zip(*_predict(texts, shared.value, penalty))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), b.column("held").slice(lo, hi - lo),
                     *(pa.array(x, f.type) for x, f in zip((lang, score, spans), list(_OUT)[2:]))], schema=_OUT)

    return docs.select(F.col("doc_id").cast("long"), (held if held is not None else F.lit(False)).alias("held"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run), "doc_id long, held boolean, lang_pred string, score double, "
             "spans array<struct<lang: string, first: long, last: long>>")


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_model(docs: DataFrame, fit_docs: int = FIT_DOCS) -> dict:
    return fit(docs.where(~held_out(F.col("doc_id"))), fit_docs)


def keep_identified(docs: DataFrame, model: dict, least_share: float, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The rows of docs whose text has a main language with at least least_share of its letters.

    The rows stay where they are: one pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, texts in text_slices(b.column("text"), BATCH_CHARS):
                keep = [k != UNKNOWN and s >= least_share for k, s, _ in _predict(texts, shared.value, penalty)]
                yield b.slice(lo, hi - lo).filter(pa.array(keep))

    return docs.mapInArrow(lean(run), docs.schema)
