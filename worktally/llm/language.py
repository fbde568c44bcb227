"""Languages of documents and of the stretches of mixed documents.

Method: multinomial naive Bayes over hashed character n-grams. A class is a language in a script,
so that a language written in two scripts is two classes. The model is fitted on a bounded sample
of labelled documents (``SAMPLE_DOCS`` for each label, chosen by a hash of the id). Further rounds
keep only the sentences that a model of the other half of the sample finds to be of their label's
class, which takes out wrong labels and mixed texts, and drop classes of nothing else. The matrix of
log probabilities (``2**HASH_BITS`` rows, one column a class) is broadcast; each Arrow batch is
scored in numpy, every distinct word once. Sentences are joined to stretches by the best path, in
which a change of language costs ``CHANGE_COST`` at a sentence's end.

Defined cases: null, empty and blank texts and texts without words have no language and give no
row; numbers, codes, symbols, addresses and markup are no words; a word's say is bounded, so a name alone makes no
stretch. Whole texts are read, of any length. Repeated rows give repeated rows. If no row of the
table has a usable label there is nothing to fit on, and no document gets a language.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.runtime import cut, shuffle_width

#: Codes and names of the languages told apart.
LABELS = {
    "en": "en eng english",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "mr": "mr mar marathi मराठी",
    "ne": "ne nep npi nepali नेपाली",
    "bn": "bn ben bengali bangla বাংলা",
    "gu": "gu guj gujarati ગુજરાતી",
    "ta": "ta tam tamil தமிழ்",
}
#: Labels that name no language.
NO_LANGUAGE = "und unknown xx zz n/a na none null nan mis mul zxx other others misc ? - --".split()

#: Labelled documents the model is fitted on, at most, for each label.
SAMPLE_DOCS = 1500
#: Rows of the matrix: 2**HASH_BITS buckets of n-grams of 1 to NGRAM letters.
HASH_BITS, NGRAM = 16, 4
#: Added to each count.
SMOOTHING = 0.1
#: A word's log odds are divided by SCALE and bounded by WORD_SAY.
SCALE, WORD_SAY = 4.0, 5.0
#: Cost of a change of language between sentences, and gain that a change within a sentence must bring.
CHANGE_COST, SPLIT_GAIN = 7.0, 16.0
#: A class is kept if so many sentences, and such a share of those with its label and script, are found to be its own.
KEPT_SENTENCES, KEPT_SHARE = 15, 0.25
#: Rounds in which the sentences of each half are judged by the model of the other half.
ROUNDS = 2
#: Words a Python worker remembers; when full, the table starts anew.
REMEMBERED_WORDS = 100_000

_UNSEEN = re.compile("[​-‏⁠﻿­]")
_WORD = re.compile(r"[^\W_]+(?:[̀-ͯऀ-ःऺ-ॏ॑-ॗॢॣঀ-ঃ়া-্ৗઁ-ઃ઼ા-્ஂா-்ௗ]+[^\W_]*)*")
_DIGIT = re.compile(r"\d")
_MARKUP = re.compile(r"<[^<>\s]{1,24}>|</?[a-zA-Z][^<>]{0,200}>|&(?:[a-zA-Z]{2,8}|#x?[0-9a-fA-F]{1,6});|\[[^\[\]\s]{1,16}\]|\S+@\S+|(?:https?://|www\.)\S+")
_END = re.compile(r"[.!?।॥|/;:\n\r  \u0085•·]+|-{2,}")
_SCRIPTS = ((0x0900, 0x097F, "Deva"), (0x0980, 0x09FF, "Beng"), (0x0A80, 0x0AFF, "Gujr"), (0x0B80, 0x0BFF, "Taml"))


def label_code(label: Column) -> Column:
    """The language a label names: a code of LABELS, ``other`` for another language, null for none."""
    bare = F.lower(F.regexp_replace(label, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    first = F.regexp_replace(bare, r"[-_].*$", "")
    named = {name: code for code, names in LABELS.items() for name in names.split()} | dict.fromkeys(NO_LANGUAGE, "")
    table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    code = F.coalesce(F.try_element_at(table, bare), F.try_element_at(table, first), F.when(bare.rlike(r"\p{L}{2}"), "other"))
    return F.when(code != "", code)


def script_of(word: str) -> str:
    """The script of a word's first letter."""
    c = ord(word[0])
    for low, high, name in _SCRIPTS:
        if low <= c <= high:
            return name
    return "Latn" if c < 0x250 else "Zzzz"


def is_word(token: str) -> bool:
    """Whether a token is a word: letters, and no more than one digit among at least three other letters."""
    if _DIGIT.search(token) is None:
        return len(token) > 1 or ord(token) > 0x24F
    return len(token) > 3 and len(_DIGIT.findall(token)) == 1


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, words in lower case) of each sentence that has words."""
    out = []
    at = 0
    text = _MARKUP.sub(lambda m: " " * len(m.group()), text)
    for m in [*_END.finditer(text), None]:
        stop = m.start() if m else len(text)
        if stop > at:
            part = unicodedata.normalize("NFC", _UNSEEN.sub("", text[at:stop])).lower()
            words = [w for w in _WORD.findall(part) if is_word(w)]
            if words:
                out.append((at, stop, words))
        at = m.end() if m else stop
    return out


def buckets(word: str) -> list[int]:
    """The hashed n-grams of a word, with marks at its ends, and the word itself."""
    padded = f"^{word}$"
    mask = (1 << HASH_BITS) - 1
    grams = [padded[i : i + n] for n in range(1, NGRAM + 1) for i in range(len(padded) - n + 1)]
    grams.append("=" + word)
    return [zlib.crc32(g.encode()) & mask for g in grams]


class Model:
    """Classes (language, script) and their log probabilities by bucket."""

    def __init__(self, classes: list[tuple[str, str]], logs: np.ndarray) -> None:
        self.classes, self.logs = classes, logs
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(classes)), dtype=np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row for each word: bounded log odds against its best class."""
        if len(self.rows) > REMEMBERED_WORDS:
            self.rows = {}
        rows = self.rows
        new = [w for w in dict.fromkeys(words) if w not in rows]
        if new:
            grams = [buckets(w) for w in new]
            starts = np.cumsum([0, *map(len, grams[:-1])])
            flat = np.fromiter((b for g in grams for b in g), dtype=np.int64)
            sums = np.add.reduceat(self.logs[flat], starts, axis=0) / SCALE
            sums = np.maximum(sums - sums.max(axis=1, keepdims=True), -WORD_SAY)
            first = len(rows)
            if first + len(new) > len(self.table):
                grown = np.zeros((2 * (first + len(new)), self.table.shape[1]), dtype=np.float32)
                grown[:first] = self.table[:first]
                self.table = grown
            self.table[first : first + len(new)] = sums
            rows.update((w, first + i) for i, w in enumerate(new))
        return self.table[np.fromiter((rows[w] for w in words), dtype=np.int64, count=len(words))]

    def languages(self) -> list[str]:
        """The language of each class."""
        return [lang for lang, _ in self.classes]


def _split_units(units: list[tuple]) -> list[tuple]:
    """Units of (start, end, word scores, their sum), split where a change within the sentence gains enough."""
    out = []
    todo = units[::-1]
    while todo:
        start, end, scores, total = todo.pop()
        n = len(scores)
        # Every word's best class scores 0, so a change can't gain more than the best whole lacks.
        if n >= 4 and -total.max() > SPLIT_GAIN:
            sums = np.cumsum(scores, axis=0, dtype=np.float64)
            whole = sums[-1].max()
            gain = sums[:-1].max(axis=1) + (sums[-1] - sums[:-1]).max(axis=1) - whole
            k = int(gain.argmax())
            if gain[k] > SPLIT_GAIN:
                middle = start + (end - start) * (k + 1) // n
                todo += [(middle, end, scores[k + 1 :], sums[-1] - sums[k]), (start, middle, scores[: k + 1], sums[k])]
                continue
        out.append((start, end, scores, total))
    return out


def stretches(text: str, model: Model) -> list[tuple[str, float, int, int, int]]:
    """(lang, confidence, start, end, n_words) of each maximal stretch of one language."""
    parts = sentences(text)
    if not parts:
        return []
    scores = model.word_scores([w for _, _, words in parts for w in words])
    ends = np.cumsum([len(words) for _, _, words in parts])
    totals = np.add.reduceat(scores, np.r_[0, ends[:-1]], axis=0, dtype=np.float64)
    units = _split_units([(a, b, scores[e - len(w) : e], t) for (a, b, w), e, t in zip(parts, ends, totals)])
    sums = np.array([u[3] for u in units])
    langs = model.languages()
    best = sums[0]
    back = []
    for row in sums[1:]:
        top = int(best.argmax())
        stay = best >= best[top] - CHANGE_COST
        back.append(np.where(stay, np.arange(len(best)), top))
        best = np.maximum(best, best[top] - CHANGE_COST) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    out = []
    i = 0
    while i < len(path):
        j = i
        while j < len(path) and langs[path[j]] == langs[path[i]]:
            j += 1
        total = sums[i:j].sum(axis=0)
        by_lang: dict[str, float] = {}
        for lang, x in zip(langs, total):
            by_lang[lang] = max(by_lang.get(lang, -np.inf), x)
        own = by_lang[langs[path[i]]]
        confidence = 1.0 / sum(np.exp(min(50.0, x - own)) for x in by_lang.values())
        out.append((langs[path[i]], float(confidence), units[i][0], units[j - 1][1], int(sum(len(u[2]) for u in units[i:j]))))
        i = j
    return out


def _count_frames(frames: Iterator[pd.DataFrame], models: list[Model] | None) -> Iterator[pd.DataFrame]:
    """(half, lang, script, bucket, n): counts of n-grams of the sentences; bucket -1 counts sentences, -2 those taken.

    With models, one for each half of the sample, only those sentences are taken that the model of
    the other half finds to be of their label's class.
    """
    counts: dict[tuple, np.ndarray] = {}
    seen: dict[tuple, list[int]] = {}
    for pdf in frames:
        taken: dict[tuple, Counter] = {}
        for text, lang, half in pdf[["text", "code", "half"]].itertuples(index=False):
            for _, _, words in sentences(text):
                kind = (int(half), lang, script_of(max(words, key=len)))
                tally = seen.setdefault(kind, [0, 0])
                tally[0] += 1
                if models is not None:
                    judge = models[1 - int(half)]
                    total = judge.word_scores(words).sum(axis=0)
                    if judge.classes[int(total.argmax())] != kind[1:]:
                        continue
                tally[1] += 1
                taken.setdefault(kind, Counter()).update(words)
        for kind, often in taken.items():
            grams = [(b, n) for w, n in often.items() for b in buckets(w)]
            at, n = np.array(grams, dtype=np.int64).T
            into = counts.setdefault(kind, np.zeros(1 << HASH_BITS, dtype=np.int64))
            np.add.at(into, at, n)
    for (half, lang, script), tally in seen.items():
        into = counts.get((half, lang, script), np.zeros(0, dtype=np.int64))
        at = np.flatnonzero(into)
        n = np.r_[into[at], tally[0], tally[1]]
        yield pd.DataFrame({"half": half, "lang": lang, "script": script, "bucket": np.r_[at, -1, -2].astype(np.int32), "n": n.astype(np.int64)})


def _built(counts: dict[tuple[str, str], np.ndarray]) -> Model | None:
    logs = {kind: np.log((c + SMOOTHING) / (c + SMOOTHING).sum()) for kind, c in sorted(counts.items()) if c.any()}
    return Model(list(logs), np.array(list(logs.values()), dtype=np.float32).T.copy()) if logs else None


def _fit_once(sample: DataFrame, models: list[Model] | None) -> tuple[list[Model] | None, Model | None]:
    """The models of the halves and of the whole sample."""
    shared = sample.sparkSession.sparkContext.broadcast([(m.classes, m.logs) for m in models] if models else None)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _count_frames(frames, [Model(*m) for m in shared.value] if shared.value else None)

    counted = sample.select("text", "code", "half").mapInPandas(run, "half int, lang string, script string, bucket int, n bigint")
    # Bounded: at most one row for each half, class and bucket.
    pdf = counted.groupBy("half", "lang", "script", "bucket").agg(F.sum("n").alias("n")).toPandas()
    whole: dict[tuple[str, str], np.ndarray] = {}
    halves: list[dict[tuple[str, str], np.ndarray]] = [{}, {}]
    for kind, part in pdf.groupby(["lang", "script"]):
        total = part.groupby("bucket")["n"].sum()
        sentences_seen, taken = int(total.get(-1, 0)), int(total.get(-2, 0))
        if kind[1] == "Zzzz" or (models is not None and (taken < KEPT_SENTENCES or taken < KEPT_SHARE * sentences_seen)):
            continue
        for half, rows in part[part["bucket"] >= 0].groupby("half"):
            column = np.zeros(1 << HASH_BITS)
            column[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
            halves[int(half)][kind] = column
            whole[kind] = whole.get(kind, 0) + column
    parts = [_built(h) for h in halves]
    return (parts if all(parts) else None), (_built(whole) if whole else None)


def fit_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The model fitted on at most ``sample_docs`` documents of each label; null if no label can be used."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), label_code(F.col(label_col)).alias("code")).filter(F.col("code").isin(*LABELS) & F.col("text").isNotNull())
    # The bound of each label's sample: the hash below which about sample_docs documents lie.
    n = {r["code"]: r["n"] for r in labelled.groupBy("code").agg(F.count("*").alias("n")).collect()}
    if not n:
        return None
    keep = F.lit(False)
    for code, count in n.items():
        share = min(1.0, sample_docs / count)
        keep = keep | ((F.col("code") == code) & (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)))
    sample = labelled.filter(keep).select("text", "code", F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).cast("int").alias("half"))
    sample = cut(sample.repartition(shuffle_width(docs.sparkSession)))
    halves, model = _fit_once(sample, None)
    for _ in range(ROUNDS):
        if halves is None:
            break
        halves, better = _fit_once(sample, halves)
        model = better or model
    return model


_MODELS: dict[int, Model] = {}


def _model_of(shared) -> Model:
    key = shared.value[2]
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(shared.value[0], shared.value[1])
    return _MODELS[key]


def segment_languages(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """(id_col, label, segment_no, lang, confidence, start, end, n_words, n_segments) of every stretch of every text.

    ``label`` is the language the given label names. start and end are places in the text.
    """
    spark = docs.sparkSession
    model = model or fit_model(docs, id_col, text_col, label_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, label string, segment_no int, lang string, confidence double, start int, end int, n_words int, n_segments int"
    if model is None:
        return spark.createDataFrame([], schema)
    stamp = int(zlib.crc32(model.logs.tobytes()))
    shared = spark.sparkContext.broadcast((model.classes, model.logs, stamp))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _model_of(shared)
        for pdf in frames:
            rows = []
            for doc, label, text in pdf.itertuples(index=False):
                found = stretches(text, own)
                rows += [(doc, label, i, *x, len(found)) for i, x in enumerate(found)]
            out = pd.DataFrame(rows, columns=["doc", "label", "segment_no", "lang", "confidence", "start", "end", "n_words", "n_segments"])
            yield out.rename(columns={"doc": id_col})

    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col), label_code(F.col(label_col)).alias("label"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInPandas(run, schema)
