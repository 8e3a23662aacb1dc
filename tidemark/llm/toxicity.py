"""Toxicity of whole texts: boosted trees over dense features, with isotonic calibration.

The features are densities of lexicons (a fixed list, and the words and beginnings of words that labelled rows show to be
toxic), the same after undoing letters written as digits or signs, how near such words stand to a second person,
capitals, punctuation and obfuscation rates. Lexicon and trees are fitted on a bounded sample (``labelled.SAMPLE``) of rows
with labels, the lexicon on one half of it and the trees on the other, so that the trees see how well the lexicon does on
rows it wasn't made from; every row is scored. Nothing but text goes into a score.

A null text is empty. Empty texts get the score that the model gives to no features, which is low unless nearly all
labels are 1. Without usable labels every score is 0.5. Repeated rows get the same score. Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.features import Lookup, per_text, surface
from tidemark.llm.frames import KEY, keyed, on_file
from tidemark.llm.labelled import SAMPLE, sample
from tidemark.llm.trees import calibrated

THRESHOLD = 0.3
LEARNED = 2048
#: Bytes of the beginnings of words.
STEMS = range(4, 9)
#: A learned entry is so many times as common in toxic texts at least, a strong one so many times.
ODDS, STRONG = 4.0, 25.0
NEAR = 6

# Common insults, and second-person pronouns, in English, German, Spanish and French.
INSULTS = (
    "idiot moron scum trash loser worthless pathetic stupid disgusting clown dumb fool jerk creep ugly garbage filthy vermin liar freak coward "
    "imbecile dumbass bastard idioten dumm trottel abschaum versager wertlos müll idiota estúpido imbécil basura asqueroso inútil payaso "
    "stupide imbécile ordure minable dégoûtant nul"
).split()
PERSONS = (
    "you your yours youre yourself u ur du dich dir dein deine ihr euch tú tu ti te usted ustedes vosotros tus toi vous votre vos"
).split()
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "*": "u"}


def _leet_table() -> tuple[np.ndarray, np.ndarray]:
    """Like tokens.LETTERS, with signs that stand for letters counted as those."""
    is_word, value = (c.copy() for c in tokens.LETTERS)
    for sign, letter in LEET.items():
        is_word[ord(sign)], value[ord(sign)] = True, value[ord(letter)]
    return is_word, value


UNDONE = _leet_table()


def hashes(words: list[str]) -> np.ndarray:
    return tokens.words(pa.array(words), tokens.LETTERS)[0]


def _entries(data, begins, ends, at) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of their beginnings, the text and the word that each is of."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    kinds = [(np.arange(len(begins)), tokens.word_hashes(data, begins, tokens.LETTERS)), *tokens.prefix_hashes(data, begins, ends, STEMS, tokens.LETTERS)]
    word = np.concatenate([w for w, _ in kinds])
    return np.concatenate([h for _, h in kinds]), text[word], word


def _presence(batches):
    """How many toxic and other texts hold each entry, for a batch."""
    for batch in batches:
        for piece in tokens.pieces(batch):
            data, offsets = tokens.text_bytes(piece.column("text"))
            found, text, _ = _entries(data, *tokens.spans(data, offsets, tokens.LETTERS))
            order = np.lexsort((text, found))
            found, text = found[order], text[order]
            once = np.concatenate(([True], (found[1:] != found[:-1]) | (text[1:] != text[:-1])))[: len(found)]
            entry, inverse = np.unique(found[once], return_inverse=True)
            bad = np.bincount(inverse, piece.column("y").to_numpy()[text[once]] > 0, len(entry)).astype(np.int64)
            n = np.bincount(inverse, minlength=len(entry)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (entry.view(np.int64), bad, n)], ["entry", "bad", "n"])


def learned(rows: DataFrame, most: int = LEARNED) -> tuple[np.ndarray, np.ndarray]:
    """The entries whose presence tells toxic texts best, ``most`` at most and each in 1 % of these or more, and their log odds."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("y") > 0, 1).otherwise(0)).alias("bad")).first()
    if not total["bad"] or total["bad"] == total["n"]:
        return np.zeros(0, np.uint64), np.zeros(0)
    counts = rows.select("text", "y").mapInArrow(_presence, "entry long, bad long, n long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    odds = F.log((F.col("bad") + 0.5) / (total["bad"] + 1) / ((F.col("n") - F.col("bad") + 0.5) / (total["n"] - total["bad"] + 1)))
    kept = counts.where(F.col("bad") >= max(4, 0.01 * total["bad"])).withColumn("odds", odds).where(F.col("odds") > math.log(ODDS))
    best = kept.orderBy(F.desc(F.col("bad") * F.col("odds")), "entry").limit(most).select("entry", "odds").collect()
    best.sort(key=lambda r: r[0] % 2**64)
    return np.array([r[0] for r in best], np.int64).view(np.uint64), np.array([r[1] for r in best], float)


class _Tools:
    def __init__(self, lexicon: tuple[np.ndarray, np.ndarray]):
        self.insults, self.persons = Lookup(hashes(INSULTS)), Lookup(hashes(PERSONS))
        self.entries, self.odds = Lookup(lexicon[0]), lexicon[1]


def _matrix(column, tools: _Tools) -> np.ndarray:
    data, offsets = tokens.text_bytes(column)
    begins, ends, at = tokens.spans(data, offsets, tokens.LETTERS)
    found, texts = tokens.word_hashes(data, begins, tokens.LETTERS), len(at) - 1
    n = np.maximum(np.diff(at), 1)
    entry, text, word = _entries(data, begins, ends, at)
    which = tools.entries.index(entry)
    hit = which >= 0
    which, text, word = which[hit], text[hit], word[hit]
    strong = np.zeros(len(found), bool)
    strong[word[tools.odds[which] >= math.log(STRONG)]] = True
    weak = np.zeros(len(found), bool)
    weak[word] = True
    # Of each text and entry: how often.
    pair, times = np.unique(text * max(1, len(tools.odds)) + which, return_counts=True)
    of, which = pair // max(1, len(tools.odds)), pair % max(1, len(tools.odds))
    most, repeated = np.zeros(texts), np.zeros(texts)
    np.maximum.at(most, of, times)
    np.maximum.at(repeated, of, tools.odds[which] * (times > 1))
    best = np.zeros(texts)
    np.maximum.at(best, of, tools.odds[which])

    undone, undone_at = tokens.words(column, UNDONE)
    insult, person = tools.insults(found), tools.persons(found)
    either = insult | strong
    # Distance in words to the nearest second person of the same text.
    place, who = np.flatnonzero(either), np.flatnonzero(person)
    near = np.zeros(len(found), bool)
    if len(place) and len(who):
        home = np.searchsorted(at, place, "right")
        for side in (np.searchsorted(who, place) - 1, np.searchsorted(who, place)):
            ok = (side >= 0) & (side < len(who))
            other = who[np.clip(side, 0, len(who) - 1)]
            near[place[ok & (np.abs(other - place) <= NEAR) & (np.searchsorted(at, other, "right") == home)]] = True
    columns = surface(data, offsets, *tokens.spans(data, offsets))
    counts = {k: per_text(c, at) for k, c in dict(insult=insult, strong=strong, weak=weak, near=near, person=person).items()}
    counts["hidden"] = np.maximum(per_text(tools.insults(undone), undone_at) - counts["insult"], 0)
    for k, c in counts.items():
        columns[f"{k}_share"], columns[f"{k}_log"] = c / n, np.log1p(c)
    columns |= {"best": best, "most": most, "repeated": repeated, "most_share": most / n}
    columns["summed"] = np.bincount(of, tools.odds[which], texts)
    return np.column_stack(list(columns.values())).astype(float)


def _features(lexicon):
    def run(batches):
        tools = _Tools(lexicon)
        for batch in batches:
            for piece in tokens.pieces(batch):
                rows = pa.array(list(_matrix(piece.column("text"), tools)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("y"), rows], ["doc_id", "y", "x"])

    return run


def _scored(sent):
    def run(batches):
        lexicon, trees, curve = sent.value
        tools = _Tools(lexicon)
        for batch in batches:
            for piece in tokens.pieces(batch):
                score = curve(trees.logit(_matrix(piece.column("text"), tools)))
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in (*KEY, "doc_id")], pa.array(score)], [*KEY, "doc_id", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE):
    """The learned lexicon, the trees and the curve."""
    known = sample(docs, labels.where(~held_out(labels["doc_id"])), "toxic", rows)
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    lexicon = learned(known.where(half == 0))
    rest = known.where(half == 1) if len(lexicon[0]) else known
    found = rest.select("doc_id", "y", "text").mapInArrow(_features(lexicon), "doc_id long, y int, x array<double>").toArrow()
    found = found.take(np.lexsort((found["y"].to_numpy(), found["doc_id"].to_numpy())))
    x = np.array(found["x"].to_pylist(), float)
    return lexicon, *calibrated(x, (found["y"].to_numpy() > 0).astype(float))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """A row per document: KEY, doc_id, held_out, score, predicted."""
    docs = on_file(docs)
    own = keyed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    found = own.mapInArrow(_scored(sent), "at_file long, at_row long, doc_id long, score double")
    return found.select(*KEY, "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


