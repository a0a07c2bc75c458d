"""Language identification of documents and of spans in mixed-language text.

Script ranges first narrow the candidates of each word to the languages that are written in its script.
Each word then gets a score for each candidate from byte n-gram frequencies of the learned languages,
and Viterbi decoding over the words, with a penalty for each switch, labels the spans. The document's
language is the one whose spans hold most letters; its score is their share of the letters.

Learning uses a bounded, documented sample (`PER_LANG` documents of each language, by a hash of the id, and of
the `CLASSES` most frequent languages, should the column hold more values than that); prediction reads whole texts and nothing else. Null texts and texts without a letter are `und` with
score 0. Ties go to the language that sorts first. Repeated rows get equal results, an empty table an
empty result; if nothing can be learned every prediction is `und`. Extra columns are ignored. Documents are
decoded side by side, and the rest of the few longest one by one, so one very long text takes no longer a word.
"""

from __future__ import annotations

import bisect
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import CLASSES, SAMPLE_CHARS, WordTable, class_sample, give_back, is_held_out, lockstep, map_texts, remainder, side_by_side, within_chars

PER_LANG = 500
BUCKETS = 1 << 16
SWITCH = 6.0  #: log-probability that a change of language costs
#: The least share of a language's training letters that a script needs to be one of its scripts.
SCRIPT_SHARE = 0.02

#: First code point of each block of letters, and its script.
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0780, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x3040, "Kana"), (0x3130, "Hangul"), (0x3190, "Other"), (0x31F0, "Kana"), (0x3400, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7FC, "Other"), (0xF900, "Han"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0x20000, "Han"),
)
_STARTS = [a for a, _ in SCRIPTS]
_LETTERS = re.compile(r"[^\W\d_]+")


def script_of(letter: str) -> str:
    return SCRIPTS[max(0, bisect.bisect_right(_STARTS, ord(letter)) - 1)][1]


def gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte bigrams and trigrams of all words, each between blanks, and the number of positions of each word."""
    raw = [f" {w} ".encode("utf-8", "surrogatepass") for w in words]
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw) + b"\x00\x00", np.uint8).astype(np.uint32)
    two = data[:-2] << 8 | data[1:-1]
    three = two << 8 | data[2:]
    # The last position of a word would reach into the next one: its bigram and the trigrams at the last two are blanked.
    ends = np.cumsum(lens)
    codes = np.stack([(two * np.uint32(2654435761)) >> 16, ((three + np.uint32(0x1000000)) * np.uint32(2246822519)) >> 16], 1).astype(np.int64)
    codes[ends - 1] = BUCKETS
    codes[ends - 2, 1] = BUCKETS
    return codes, lens


class LanguageModel:
    def __init__(self, sample: list[tuple[str, str]], shares: dict[str, float]):
        self.langs = sorted(shares)
        n = len(self.langs)
        counts = np.zeros((BUCKETS + 1, n))
        scripts: list[dict[str, int]] = [{} for _ in range(n)]
        for k, lang in enumerate(self.langs):
            for text, own in sample:
                if own != lang:
                    continue
                words = _LETTERS.findall(text.lower())
                if words:
                    codes, _ = gram_codes(words)
                    counts[:, k] += np.bincount(codes.ravel(), minlength=BUCKETS + 1)
                    for w in words:
                        s = script_of(w[0])
                        scripts[k][s] = scripts[k].get(s, 0) + len(w)
        counts[BUCKETS] = 0
        seen = counts.sum(0)
        logs = np.log((counts + 0.5) / (seen + 0.5 * BUCKETS))
        self.gain = (logs - logs.mean(1, keepdims=True)).astype(np.float32) if n else logs.astype(np.float32)
        self.gain[BUCKETS] = 0
        self.prior = np.log(np.array([max(shares[x], 1e-6) for x in self.langs])) if n else np.zeros(0)
        names = sorted({s for _, s in SCRIPTS})
        self.allowed = {s: np.array([own.get(s, 0) >= SCRIPT_SHARE * max(1, sum(own.values())) for own in scripts], bool) for s in names}

    def word_scores(self, tokens: list[str]) -> np.ndarray:
        """For each token, its score for each language; then its letters."""
        out = np.zeros((len(tokens), len(self.langs) + 1), np.float32)
        words, at = [], []
        for i, t in enumerate(tokens):
            for w in (t,) if t.isalpha() else _LETTERS.findall(t):
                words.append(w)
                at.append(i)
        if not words:
            return out
        codes, lens = gram_codes(words)
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        sums = np.add.reduceat(self.gain[codes[:, 0]] + self.gain[codes[:, 1]], starts) * 0.5
        for i, w in enumerate(words):
            if not (w.isascii() and self.allowed["Latin"].all()):
                ok = self.allowed[script_of(w[0])]
                if ok.any() and not ok.all():
                    sums[i][~ok] = sums[i].min() - 20
        np.add.at(out, np.array(at), np.column_stack([sums, [len(w) for w in words]]).astype(np.float32))
        return out

    def paths(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The language of each word, by Viterbi, for documents whose words stand one after another."""
        order, active = lockstep(lengths)
        starts = (np.cumsum(lengths) - lengths)[order]
        path = np.zeros(len(scores), np.int16)
        if not len(active):
            return path
        switched = np.zeros(scores.shape, bool)
        source = np.zeros(len(scores), np.int16)
        v = np.zeros((len(lengths), len(self.langs)))
        v[: active[0]] = self.prior + scores[starts[: active[0]]]
        lanes = np.arange(len(lengths))
        alone = side_by_side(active)
        for t in range(1, alone):
            n = active[t]
            rows = starts[:n] + t
            best = v[:n].argmax(1)
            top = (v[lanes[:n], best] - SWITCH)[:, None]
            swap = v[:n] < top
            v[:n] = np.where(swap, top, v[:n]) + scores[rows]
            switched[rows], source[rows] = swap, best
        # The words of the few longest documents, one document after another.
        for i in range(active[alone] if alone < len(active) else 0):
            own = v[i].tolist()
            for row in range(starts[i] + alone, starts[i] + lengths[order[i]]):
                top = max(own)
                best = own.index(top)
                top -= SWITCH
                swap = [x < top for x in own]
                own = [(top if y else x) + z for x, y, z in zip(own, swap, scores[row].tolist(), strict=True)]
                if any(swap):
                    switched[row], source[row] = swap, best
            v[i] = own
        state = v.argmax(1)
        for i in range(active[alone] if alone < len(active) else 0):
            k = int(state[i])
            for row in range(starts[i] + int(lengths[order[i]]) - 1, starts[i] + alone - 1, -1):
                path[row] = k
                if switched[row, k]:
                    k = int(source[row])
            state[i] = k
        for t in range(alone - 1, -1, -1):
            n = active[t]
            rows = starts[:n] + t
            path[rows] = state[:n]
            if t:
                state[:n] = np.where(switched[rows, state[:n]], source[rows], state[:n])
        return path


class Identifier:
    """Predicts whole texts with a model; keeps scores of words between calls."""

    def __init__(self, model: LanguageModel):
        self.model, self.table = model, WordTable(model.word_scores)

    def label(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of words of each text, the language of each word and its letters."""
        tokens, lengths = [], []
        for t in texts:
            own = t.lower().split()
            tokens += own
            lengths.append(len(own))
        lengths = np.array(lengths, np.int64)
        if not tokens or not self.model.langs:
            return lengths, np.zeros(len(tokens), np.int16), np.zeros(len(tokens))
        at = self.table.look_up(tokens)
        rows = self.table.rows
        scores = rows[at, :-1]
        return lengths, self.model.paths(scores, lengths), rows[at, -1]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs = self.model.langs
        lengths, path, letters = self.label(texts)
        if not langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        doc = np.repeat(np.arange(len(texts)), lengths)
        share = np.bincount(doc * len(langs) + path, weights=letters, minlength=len(texts) * len(langs)).reshape(len(texts), len(langs))
        total = share.sum(1)
        best = share.argmax(1)
        score = np.divide(share[np.arange(len(texts)), best], total, out=np.zeros(len(texts)), where=total > 0)
        return [langs[b] if n else "und" for b, n in zip(best.tolist(), total.tolist(), strict=True)], score.tolist()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Stretches (start, end, language) of one text, offsets in code points."""
        lengths, path, letters = self.label([text])
        out: list[tuple[int, int, str]] = []
        # lower() may lengthen a text, so words are found in the text itself.
        for m, k, n in zip(re.finditer(r"\S+", text), path.tolist(), letters.tolist(), strict=True):
            lang = self.model.langs[k] if self.model.langs and n else None
            if lang and out and out[-1][2] == lang:
                out[-1] = (out[-1][0], m.end(), lang)
            elif lang:
                out.append((m.start(), m.end(), lang))
        return out


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> LanguageModel:
    """Learns from text and non-null lang of documents whose crc32(doc_id) mod 5 is not 0."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang").filter((remainder("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r[0]: r[1] for r in own.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(CLASSES).collect()}
    rows = sorted((r.text, r.lang) for r in within_chars(class_sample(own, "lang", per_lang), F.xxhash64(F.lit("sample"), "doc_id"), SAMPLE_CHARS, "lang"))
    known = {lang for _, lang in rows}
    return LanguageModel(rows, {k: v / sum(counts.values()) for k, v in counts.items() if k in known})


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = fit(docs, per_lang)

    def make():
        who = Identifier(model)

        def run(cols, texts):
            lang, score = who.predict(texts)
            return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": lang, "score": score}

        return run

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out("doc_id", 5, 0).alias("held_out"), "text")
    return map_texts(rows, "doc_id bigint, held_out boolean, lang_pred string, score double", make)


def recognised(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The rows, with all their columns, whose text is in a learned language; those labelled `und` go."""
    model = fit(docs, per_lang)

    def run(batches):
        import pyarrow as pa

        who = Identifier(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index("text")).to_pylist()]
            keep: list[bool] = []
            at, size = 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size > 2_000_000 or i == len(texts) - 1:
                    keep += [lang != "und" for lang in who.predict(texts[at : i + 1])[0]]
                    at, size = i + 1, 0
            yield batch.filter(pa.array(keep, pa.bool_()))
        del who
        give_back()

    return docs.mapInArrow(run, docs.schema)
