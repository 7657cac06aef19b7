"""Problem 7: missing or wrong language labels.

Averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent in numpy, with a
temperature fitted on held-out segments and rejection of unsure ones. A document is cut into segments (sentences,
within them Latin and other letters apart); each gets a language and a calibrated confidence. Two languages that
hold at least a fifth of the accepted letters each make the document `mul`.

Training uses some SAMPLE_ROWS rows, drawn by hash; a segment counts only if its row's label agrees with its script
and, where a script serves several languages, with frequent function words (labels here are often wrong). All
rows are judged, whole.

Because the model is linear, a word's share of the logits is computed once a worker and kept; a batch is one
gather and one sum per segment.

Null, empty and sentinel texts, and texts without letters, give language null, confidence null and no case.
Repeated rows give repeated results, reported once by p7_found. Columns besides id, label and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import SENTINEL, sample, table

CLASSES = ["en", "hi", "hi-Latn", "mr", "bn", "ta", "ur", "ja", "zh"]
LANG_OF = ["en", "hi", "hi", "mr", "bn", "ta", "ur", "ja", "zh"]
SAMPLE_ROWS = 4000  # rows of the training sample
SEGMENTS = 40  # training segments of a text at most
PER_CLASS = 300  # training segments per class at most
BUCKETS, DIM, EPOCHS, RATE, BATCH = 1 << 14, 16, 8, 2.0, 32
SMOOTH = 0.02  # label smoothing: keeps confidences off 1
SHORT_WORDS, SHORT_CHARS = 6, 8  # shorter segments are judged by their context
REJECT = 0.55  # a segment under this confidence isn't counted
SHARE = 0.2
VOCAB = 250_000  # words a worker remembers before it starts over

# Names, own names and codes of the languages, lower case.
LABELS = {
    "en": "en eng english", "hi": "hi hin hindi हिन्दी हिंदी", "mr": "mr mar marathi मराठी", "bn": "bn ben bengali bangla বাংলা",
    "ta": "ta tam tamil தமிழ்", "ur": "ur urd urdu اردو", "ja": "ja jpn japanese 日本語", "zh": "zh zho chi chinese mandarin 中文 汉语 漢語",
    "mul": "mul mixed multiple multilingual",
}
UNKNOWN = ["", "unknown", "und", "none", "n/a", "na", "null", "nan", "undetermined", "unk", "-", "--", "?", "??", "not known", "other"]
# A chosen list: frequent function words that confirm a label where a script serves several languages.
CONFIRM = {
    "en": "the of and to a in is was for on at by that with not has before from without we our my this are be it he as",
    "hi-Latn": "ke ko ne ka ki hai se par nahi kar aur mein bhi diya ya yeh kya mera hui thi raha kiya liya",
    "hi": "के को ने का की है से पर नहीं और में भी दिया या यह क्या मेरा किया लिया",
    "mr": "आहे आणि नाही केला माझा हा या चा ची चे आला केले दिला होता कधी असूनही आमचा ठेवला नाकारला",
}

_MARKUP = re.compile(
    r"(?s:```.*?```|~~~.*?~~~|<pre>.*?</pre>|<style.*?</style>|<script.*?</script>|<!--.*?-->|<(?:ul|ol|table)\b.*?</(?:ul|ol|table)>|\\begin\{(\w+)\*?\}.*?\\end\{\1\*?\}|\{\|.*?\n\|\}|\{\{.*?\}\}|\[\[File:.*?\]\][^\n]*)"
    r"|^[ \t]*[*+\-:|!>][^\n]*$|</?[A-Za-z][^<>\n]*>|\\[A-Za-z]+|&\w+;|\]\([^)\s]*\)",
    re.M | re.I,
)
_MARKUP_SIGN = re.compile(r"[`~<\\{|\[&]|^[ \t]*[*+\-:>!]", re.M)
_SPELLED = re.compile(r"(?<!\S)\S+ (?:[\[(]at[\])]|at) \S+ (?:[\[(]dot[\])]|dot) \S+(?: (?:[\[(]dot[\])]|dot) \S+)*", re.I)
_DATA = re.compile(r"(?<![!-~])(?:[!-/:-?A-~]*[0-9@]|https?:|[A-Za-z]:\\)[!-~]*|[०-९০-৯۰-۹]+")
_CUT = re.compile(r"[.!?।॥。！？۔؟\n]+")
_LATIN = re.compile(r"[A-Za-z\u00c0-\u024f]+")
_OTHER = re.compile(r"[\u0620-\u065f\u066e-\u06d3\u06d5-\u06ef\u06fa-\u06ff\u0750-\u077f]+|[\u0900-\u0963\u0971-\u0dff]+|[\u3041-\u30ff]{1,3}|[\u3400-\u9fff]{1,2}")
SCRIPTS = [("Arab", 0x600, 0x77F), ("Deva", 0x900, 0x97F), ("Beng", 0x980, 0x9FF), ("Taml", 0xB80, 0xBFF), ("Kana", 0x3041, 0x30FF), ("Han", 0x3400, 0x9FFF)]


def segments(text: str) -> list[list[str]]:
    """Words of each segment; markup, code and personal data are left out unless nothing else remains."""
    kept = _MARKUP.sub("\n", text) if _MARKUP_SIGN.search(text) else text
    if "dot" in kept:
        kept = _SPELLED.sub("\n", kept)
    kept = _DATA.sub(" ", kept)
    if not _LATIN.search(kept) and not _OTHER.search(kept):
        kept = text
    out = []
    kept = kept.lower()
    for part in dict.fromkeys(_CUT.split(kept)):  # a line that comes again (a running header) counts once
        if part.isascii():
            if words := _LATIN.findall(part):
                out.append(words)
        else:
            if words := _OTHER.findall(part):
                out.append(words)
            if words := _LATIN.findall(part):
                out.append(words)
    return out


def subwords(word: str) -> list[int]:
    w = f"<{word}>"
    grams = [w] + [w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1)]
    return [zlib.crc32(g.encode()) % BUCKETS for g in grams]


def script_of(words: list[str]) -> str:
    count: dict[str, int] = {}
    for w in words:
        c = ord(w[0])
        name = next((s for s, a, b in SCRIPTS if a <= c <= b), "Latn")
        count[name] = count.get(name, 0) + len(w)
    if count.get("Kana", 0) * 5 >= sum(count.values()):
        return "Kana"
    return max(count, key=count.get)


def reliable_class(words: list[str], label: str | None) -> int | None:
    """Class of a training segment, if the row's label, the script and function words agree."""
    script = script_of(words)
    fixed = {"Arab": "ur", "Beng": "bn", "Taml": "ta", "Kana": "ja", "Han": "zh"}.get(script)
    if fixed:
        return CLASSES.index(fixed) if label in (fixed, "mul") and sum(map(len, words)) >= 8 else None
    pair = ("hi", "mr") if script == "Deva" else ("en", "hi-Latn")
    seen = set(words)
    hits = [sum(w in seen for w in CONFIRM[c].split()) for c in pair]
    if max(hits) < 2 or min(hits) * 3 > max(hits):
        return None
    name = pair[int(hits[1] > hits[0])]
    return CLASSES.index(name) if label in (name.split("-")[0], "mul") else None


class LanguageModel:
    """Embeddings and softmax; table holds every bucket's contribution to the logits."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.out = np.zeros((DIM, len(CLASSES)), dtype=np.float32)
        self.temperature = 1.0

    @staticmethod
    def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        idx, wt = [], []
        total = sum(map(len, words))
        for w in words:
            g = subwords(w)
            idx += g
            wt += [len(w) / total / len(g)] * len(g)
        return np.array(idx), np.array(wt, dtype=np.float32)

    def fit(self, data: list[tuple[list[str], int]], seed: int = 7) -> "LanguageModel":
        rng = np.random.default_rng(seed)
        x = [self.features(w) for w, _ in data]
        y = np.array([c for _, c in data])
        order = rng.permutation(len(data))
        held = order[: len(data) // 10]
        order = order[len(data) // 10 :]
        weight = len(y) / np.maximum(np.bincount(y, minlength=len(CLASSES)), 1) / len(CLASSES)
        weight = np.minimum(weight, 4.0)
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(order)
            for i in range(0, len(order), BATCH):
                part = order[i : i + BATCH]
                idx = np.concatenate([x[k][0] for k in part])
                wt = np.concatenate([x[k][1] for k in part])
                size = np.array([len(x[k][0]) for k in part])
                row = np.repeat(np.arange(len(part)), size)
                hidden = np.add.reduceat(self.emb[idx] * wt[:, None], np.concatenate([[0], np.cumsum(size)[:-1]]), axis=0)
                grad = softmax(hidden @ self.out)
                grad -= SMOOTH / len(CLASSES)
                grad[np.arange(len(part)), y[part]] -= 1 - SMOOTH
                grad *= weight[y[part]][:, None]
                back = grad @ self.out.T
                self.out -= rate * hidden.T @ grad / len(part)
                np.add.at(self.emb, idx, -rate * back[row] * wt[:, None])
        if len(held):
            logits = np.array([self.logits(data[k][0]) for k in held])
            grid = np.geomspace(0.5, 5, 40)
            loss = [-np.log(softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-9).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
            self.accuracy = float((logits.argmax(1) == y[held]).mean())
        return self

    def logits(self, words: list[str]) -> np.ndarray:
        idx, wt = self.features(words)
        return (self.emb[idx] * wt[:, None]).sum(0) @ self.out

    def bucket_table(self) -> np.ndarray:
        return (self.emb @ self.out / self.temperature).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class Judge:
    """Segment and document decisions of a worker."""

    def __init__(self, bucket_table: np.ndarray):
        self.buckets = bucket_table
        self.ids: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, len(CLASSES)), dtype=np.float32)
        self.lens = np.zeros(1 << 12, dtype=np.float32)

    def learn(self, words: set[str]) -> None:
        first, need = len(self.ids), len(self.ids) + len(words)
        while need > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.lens = np.concatenate([self.lens, np.zeros_like(self.lens)])
        for i, w in enumerate(words, first):
            self.ids[w] = i
            self.rows[i] = self.buckets[subwords(w)].mean(axis=0) * len(w)
            self.lens[i] = len(w)

    def batch(self, texts: list[str | None]) -> list[list[tuple[list[str], str | None, float, int]]]:
        """For each text its segments: words, language or null if rejected, confidence, letters."""
        if len(self.ids) > VOCAB:
            self.ids.clear()
        cut = [segments(t) if t else [] for t in texts]
        flat, ends = [], []
        for doc in cut:
            for seg in doc:
                flat += seg
                ends.append(len(flat))
        if not flat:
            return [[] for _ in texts]
        self.learn(set(flat) - self.ids.keys())
        ix = np.fromiter(map(self.ids.__getitem__, flat), dtype=np.int64, count=len(flat))
        at = np.concatenate([[0], ends[:-1]]).astype(int)
        letters = np.add.reduceat(self.lens[ix], at)
        p = softmax(np.add.reduceat(self.rows[ix], at, axis=0) / letters[:, None])
        # Latin and other Hindi are one language
        best, sure = p.argmax(axis=1), p.max(axis=1)
        out, k = [], 0
        for doc in cut:
            own = []
            for seg in doc:
                own.append((seg, LANG_OF[best[k]] if sure[k] >= REJECT else None, float(sure[k]), int(letters[k])))
                k += 1
            out.append(own)
        return out


def in_context(segs: list[tuple]) -> list[tuple]:
    """Segments too short to tell take the language that the longer ones of their script hold; without any they are rejected
    if the text has longer segments in another script."""
    long: dict[bool, dict[str, int]] = {False: {}, True: {}}
    for words, lang, _, letters in segs:
        if lang and not is_short(words, letters):
            own = long[words[0].isascii()]
            own[lang] = own.get(lang, 0) + letters
    if not long[True] and not long[False]:
        return segs
    usual = {k: max(v, key=v.get) if v else None for k, v in long.items()}
    return [(w, usual[w[0].isascii()], c, n) if is_short(w, n) else (w, x, c, n) for w, x, c, n in segs]


def is_short(words: list[str], letters: int) -> bool:
    return letters < SHORT_CHARS if words[0] >= "\u3041" else len(words) < SHORT_WORDS


def decide(segs: list[tuple]) -> tuple[str | None, float | None]:
    segs = in_context(segs)
    held: dict[str, float] = {}
    sure: dict[str, float] = {}
    for _, lang, conf, letters in segs:
        if lang:
            held[lang] = held.get(lang, 0) + letters
            sure[lang] = sure.get(lang, 0) + letters * conf
    total = sum(held.values())
    if not total:
        if not segs:
            return None, None
        best = max(segs, key=lambda s: s[2])
        return "und", best[2]
    large = [x for x in held if held[x] >= SHARE * total]
    conf = sum(sure.values()) / total
    return ("mul" if len(large) > 1 else max(held, key=held.get)), conf


def code_of(label: Column) -> Column:
    """Code of a label in any spelling; null for labels that are missing or a word for unknown; else the label."""
    x = F.lower(F.trim(label))
    out = F.when(label.isNull() | x.isin(UNKNOWN), F.lit(None).cast("string"))
    for code, names in LABELS.items():
        out = out.when(x.isin(names.split()), F.lit(code))
    return out.otherwise(x)


def train(df: DataFrame, label_col: str, text_col: str, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on the labelled ones of some sample_rows rows of df."""
    drawn = sample(df.select(F.col(label_col).alias("label"), F.col(text_col).alias("text")), sample_rows).withColumn("label", code_of(F.col("label")))
    rows = drawn.filter(F.col("label").isin(list(LABELS)) & ~F.col("text").rlike(SENTINEL))
    taken: dict[int, list] = {}
    for label, text in sorted(map(tuple, rows.collect())):
        for words in segments(text)[:SEGMENTS]:
            c = reliable_class(words, label)
            if c is not None and len(taken.setdefault(c, [])) < PER_CLASS:
                taken[c].append(words)
    data = [(w, c) for c in sorted(taken) for w in taken[c]]
    # the function words themselves anchor classes of which the sample has little
    data += [(CONFIRM[c].split()[i::3], CLASSES.index(c)) for c in CONFIRM for i in range(3)]
    return LanguageModel().fit(data)


_judges: dict[int, Judge] = {}


def judge_of(bucket_table: np.ndarray) -> Judge:
    """The worker's judge for a broadcast model, built once; it holds the table, so its id isn't used again."""
    if id(bucket_table) not in _judges:
        _judges.clear()
        _judges[id(bucket_table)] = Judge(bucket_table)
    return _judges[id(bucket_table)]


def tag(df: DataFrame, id_col: str, label_col: str, text_col: str, model: LanguageModel, with_segments: bool = False) -> DataFrame:
    """id, label (code of the given label), lang, confidence; with_segments: one row per segment instead.

    Segment rows have segment_no, text_words, lang (null if rejected) and confidence.
    """
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model.bucket_table())  # BUCKETS x classes floats, under 1 MB
    out = f"{id_col} {kind}, " + ("segment_no int, segment string, lang string, confidence double" if with_segments else "label string, lang string, confidence double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = judge_of(shared.value)
        for b in batches:
            ids, labels = b.column(0), b.column(1)
            found = judge.batch(b.column(2).to_pylist())
            if with_segments:
                rows = [(i, n, " ".join(w), lang, conf) for i, segs in zip(ids.to_pylist(), map(in_context, found)) for n, (w, lang, conf, _) in enumerate(segs, 1)]
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], ids.type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.float64())],
                    names=[id_col, "segment_no", "segment", "lang", "confidence"],
                )
            else:
                lang, conf = zip(*map(decide, found)) if found else ([], [])
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(lang, pa.string()), pa.array(conf, pa.float64())], names=[id_col, "label", "lang", "confidence"])

    text = F.when(~F.col(text_col).rlike(SENTINEL), F.col(text_col))
    return df.select(id_col, code_of(F.col(label_col)).alias("label"), text.alias("text")).mapInArrow(run, out)


def p7_languages(spark, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "sheet3")
    model = train(sheet, "language", "full_extracted_text")
    return tag(sheet, "record_id", "language", "full_extracted_text", model).distinct()


def p7_segments(spark, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "sheet3")
    model = train(sheet, "language", "full_extracted_text")
    return tag(sheet, "record_id", "language", "full_extracted_text", model, with_segments=True).distinct()


def p7_found(spark, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "sheet3")
    model = train(sheet, "language", "full_extracted_text")
    judged = tag(sheet, "record_id", "language", "full_extracted_text", model)
    wrong = F.col("label").isNull() | (F.col("label") != F.col("lang"))
    return judged.filter(F.col("lang").isNotNull() & (F.col("lang") != "und") & wrong).select("record_id", "lang").distinct()


QUERIES = {"p7_found": p7_found, "p7_languages": p7_languages, "p7_segments": p7_segments}
ORACLES: dict[str, str] = {}
