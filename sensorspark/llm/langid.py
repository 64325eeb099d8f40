"""Language identification of mixed-language text.

A word is a run of letters.  The script of its letters narrows the languages it may belong
to; hashed character trigrams, with the word's edges, score it under each of these; Viterbi
over the words of a text, with a penalty for every switch, labels its spans.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.llm.common import batches, mix64

# First code points of script ranges; letters from one entry up to the next
# belong to its script.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "burmese"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3005, "han"), (0x3041, "kana"), (0x3105, "other"), (0x3131, "hangul"),
    (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"),
    (0xA6A0, "other"), (0xA722, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7FC, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
    (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
]
NAMES = sorted({name for _, name in SCRIPTS})
CELLS = 1 << 17
# Bytes of text that go through Viterbi together in one task.
PIECE = 8 << 20
UNKNOWN = "und"


@cache
def _script_of() -> np.ndarray:
    """By code point: 0 for what is no letter, else one more than the index of its script."""
    at = np.array([a for a, _ in SCRIPTS])
    script = np.array([NAMES.index(name) + 1 for _, name in SCRIPTS], np.uint8)
    points = np.arange(0x110000)
    out = script[np.searchsorted(at, points, side="right") - 1]
    letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
    return np.where(letter, out, 0).astype(np.uint8)


def _features(texts: list[str]):
    """Trigram cells of all words: ``(cells, first cell of each word, script, letters, begin, first word of each text)``.

    ``begin`` is the position of a word's first letter in its text.  A word of n letters has
    n + 1 trigrams, the first and the last reach over its edges.
    """
    low = [t.lower() if len(t.lower()) == len(t) else t for t in texts]
    points = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([1, *[len(t) + 1 for t in low]])
    script = _script_of()[points]
    letter = script > 0
    symbol = np.where(letter, points, 0).astype(np.uint64)
    used = letter.copy()
    used[1:] |= letter[:-1]
    at = np.flatnonzero(used)
    with np.errstate(over="ignore"):
        # Where a word ends its last two letters stand with the edge.
        h = symbol[at] * np.uint64(0x9E3779B97F4A7C15) + symbol[at - 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        two = np.where((at > 1) & letter[at - 1], symbol[at - 2], 0).astype(np.uint64)
        cells = (mix64(h + two * np.uint64(0x165667B19E3779F9)) % np.uint64(CELLS)).astype(np.int32)
    first = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    last = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    word = np.searchsorted(first, starts)
    inside = np.repeat(starts[:-1], np.diff(word))
    return cells, np.searchsorted(at, first), script[first], last - first, first - inside, word


@dataclass
class Model:
    """Log probabilities of cells by language, and the scripts each language was seen in."""

    languages: list[str]
    score: np.ndarray
    allowed: np.ndarray


def fit(rows: DataFrame, per_language: int = 4000, smoothing: float = 0.2) -> Model:
    """Learn from ``(doc_id, text, lang)`` rows with a language.

    At most ``per_language`` whole texts of each language are read, chosen by a hash of
    ``doc_id``; the model's size depends on the number of languages alone.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    known = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ids = known.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    # Bounded: per_language ids for each language.
    chosen = known.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi").select("lang", "text")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in batches(whole, "text", 2 << 20):
                langs = part.column("lang").to_pylist()
                cells, begin, script, letters, _, word = _features(part.column("text").to_pylist())
                text = np.repeat(np.arange(len(langs)), np.diff(word))
                of_cell = np.repeat(text, np.diff(np.r_[begin, len(cells)]))
                for lang in sorted(set(langs)):
                    mine = np.array([x == lang for x in langs])
                    n = np.bincount(cells[mine[of_cell]], minlength=CELLS)
                    s = np.bincount(script[mine[text]], weights=letters[mine[text]], minlength=len(NAMES) + 1).astype(np.int64)
                    cell = np.flatnonzero(n)
                    seen = np.flatnonzero(s)
                    yield pa.record_batch(
                        {
                            "lang": pa.array([lang] * (len(cell) + len(seen)), pa.string()),
                            "cell": pa.array(np.r_[cell, -seen].astype(np.int32)),
                            "n": pa.array(np.r_[n[cell], s[seen]].astype(np.int64)),
                        }
                    )

    table = chosen.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    lang = pc.index_in(table.column("lang").combine_chunks(), pa.array(languages, pa.string())).to_numpy() if languages else np.zeros(0, int)
    cell, n = table.column("cell").to_numpy(), table.column("n").to_numpy()
    counts = np.full((CELLS, len(languages)), smoothing)
    counts[cell[cell >= 0], lang[cell >= 0]] += n[cell >= 0]
    scripts = np.zeros((len(NAMES) + 1, len(languages)))
    scripts[-cell[cell < 0], lang[cell < 0]] = n[cell < 0]
    # A script belongs to a language if a hundredth of its letters have it.
    allowed = scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32), allowed)


def viterbi(score: np.ndarray, word: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word; ``word`` has the first word of each text and the end.

    All texts go ahead together, word by word, the longest first.
    """
    n, k = score.shape
    size = np.diff(word)
    order = np.argsort(-size, kind="stable")
    first, size = word[:-1][order], size[order]
    stay, source, label = np.ones((n, k), bool), np.zeros(n, np.int16), np.zeros(n, np.int16)
    value = np.zeros((len(first), k), np.float64)
    going = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    for t, m in enumerate(going.tolist()):
        at, v = first[:m] + t, value[:m]
        best = v.argmax(axis=1)
        switched = v[np.arange(m), best] - penalty
        keep = v >= switched[:, None]
        stay[at], source[at] = keep, best
        value[:m] = np.where(keep, v, switched[:, None]) + score[at]
    state = value.argmax(axis=1) if k else np.zeros(len(first), int)
    for t in range(len(going) - 1, -1, -1):
        m = going[t]
        at = first[:m] + t
        label[at] = state[:m]
        state[:m] = np.where(stay[at, state[:m]], state[:m], source[at])
    return label


def label(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), penalty: float = 8.0, spans: bool = True) -> DataFrame:
    """``keep``, ``lang_pred``, ``score`` and ``spans`` for every row of ``docs``.

    ``lang_pred`` is the language of most letters (the first by name if several), ``und`` for
    a NULL text, one without a letter, or a model that has learned nothing; ``score`` is its
    share of the letters.  ``spans`` lists ``(begin, end, lang)`` in characters.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = [*model.languages, UNKNOWN]
        k = len(model.languages)
        for whole in (piece for batch in parts for piece in batches(batch, "text", PIECE)):
            scores, words, letters, begins, total = [], [np.zeros(1, np.int64)], [], [], 0
            for part in batches(whole, "text", PIECE >> 4):
                cells, begin, script, size, at, word = _features(pc.fill_null(part.column("text"), "").to_pylist())
                if len(begin):
                    s = np.add.reduceat(model.score[cells], begin, axis=0)
                    s[~model.allowed[script]] -= 1e4
                    scores.append(s)
                letters.append(size)
                begins.append(at)
                words.append(word[1:] + total)
                total += word[-1]
            if not len(whole):
                continue
            word = np.concatenate(words)
            size, at = np.concatenate(letters), np.concatenate(begins)
            score = np.concatenate(scores) if scores else np.zeros((0, k), np.float32)
            found = viterbi(score, word, penalty) if k else np.zeros(len(size), np.int16)
            text = np.repeat(np.arange(len(whole)), np.diff(word))
            mass = np.zeros((len(whole), k + 1))
            if k:
                np.add.at(mass, (text, found), size)
            sums = mass.sum(axis=1)
            best = np.where(sums > 0, mass.argmax(axis=1), k)
            share = mass[np.arange(len(whole)), best] / np.maximum(sums, 1)
            out = {c: whole.column(c) for c in keep}
            out |= {"lang_pred": pa.array([names[i] for i in best.tolist()], pa.string()), "score": pa.array(np.where(sums > 0, share, 0.0))}
            if spans:
                fresh = np.ones(len(found), bool)
                fresh[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
                s = np.flatnonzero(fresh)
                e = np.r_[s[1:], len(found)] - 1 if len(s) else s
                parts_ = pa.StructArray.from_arrays(
                    [pa.array(at[s].astype(np.int64)), pa.array((at[e] + size[e]).astype(np.int64)), pa.array([names[i] for i in found[s].tolist()], pa.string())],
                    ["begin", "end", "lang"],
                )
                out["spans"] = pa.ListArray.from_arrays(pa.array(np.searchsorted(s, word).astype(np.int32)), parts_)
            yield pa.record_batch(out)

    source = docs.select(*dict.fromkeys((*keep, "text")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    more = ", spans array<struct<begin:long,end:long,lang:string>>" if spans else ""
    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double{more}")


def held_out(name: str = "doc_id"):
    """True for the fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accepted(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text has a language that holds ``least`` of its letters.

    The model is learned from the labelled rows of ``docs`` outside the held-out fold.
    """
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), "text")
    judged = label(rows, model, keep=("row", "text"), spans=False)
    stays = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return stays.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
