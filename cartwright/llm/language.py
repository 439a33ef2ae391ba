"""Language identification by compression with per-language Zstandard dictionaries.

Each language's dictionary is raw content: excerpts of texts known to be in it. A text is cut into segments, every
segment is compressed once per dictionary, and the language with the smallest sum of sizes wins; what a narrow margin to
the runner-up leaves in doubt is marked in ``accepted``.

Bounds: a dictionary takes excerpts of ``EXCERPT`` characters from about ``EXCERPTS`` documents per language, as many as it
has room for. Documents are chosen by a hash of id and text and an excerpt's place in its text by another, so a text
counts in all its length and repeated rows count once. What reaches the driver is ``DICTIONARY`` bytes per language. Every
text is folded and compressed whole, where it lies, without a shuffle; a very long one takes a few times its size.

Defined cases: null text, and text without a letter, is ``und`` with score 0; equal sizes go to the language with more
rows to learn from, then to the first name; null languages are not learned; a null id counts as held out; with nothing
to learn from all is ``und``; columns named like a result give way to it; an empty table gives an empty result. Every distinct
language is learned, each for a dictionary in every worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.base import rest_of, texts, unrest
from cartwright.llm.toxicity import fold

EXCERPTS = 230
EXCERPT = 300
DICTIONARY = 64 << 10
SEGMENT = 4 << 10
LEVEL = 5
#: The least margin, as a share of the runner-up's size, that is accepted.
MARGIN = 0.01

_ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: Every ASCII byte that is no letter becomes a space.
_SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 0x20 for b in range(256))


def folded(raw: bytes) -> bytes:
    """Lower case, with one space for any run of ASCII characters that are no letters: what tells languages apart."""
    return b" ".join(raw.decode(errors="replace").lower().encode().translate(_SPACED).split())


def learn(docs: DataFrame, seed: int = 0) -> dict[str, bytes]:
    """A raw-content dictionary per language of ``docs (id, text, lang)``, most frequent language first."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    counts = known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").collect()
    if not counts:
        return {}
    share = F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    parts = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(EXCERPTS / r["count"]))])
    place = F.pmod(F.xxhash64("text", "id", F.lit(seed + 1)), F.greatest(F.lit(1), F.length("text") - EXCERPT + 1)).cast("int") + 1
    taken = (known.where(share < parts[F.col("lang")]).select("lang", share.alias("at"), F.col("text").substr(place, F.lit(EXCERPT)).alias("t"))
             .distinct().orderBy("lang", "at", "t").collect())
    found = {}
    for row in counts:
        mine = [r["t"] for r in taken if r["lang"] == row["lang"]]
        content = folded("\n".join(mine).encode())[-DICTIONARY:]  # the last bytes if a few too many were drawn
        if len(content) >= 8:
            found[row["lang"]] = content
    return found


def has_letter(raw: bytes | None) -> bool:
    return bool(raw) and (bool(_ASCII_LETTER.search(raw)) or any(map(str.isalpha, raw.decode(errors="replace"))))


class Sizer:
    """Compressed sizes of texts under every dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.compressors = []
        for content in dictionaries.values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, raw: bytes) -> list[int]:
        segments = [raw[i:i + SEGMENT] for i in range(0, len(raw), SEGMENT)]
        return [sum(len(c.compress(s)) for s in segments) for c in self.compressors]


def _judged(batches: Iterator[pa.RecordBatch], dictionaries: dict[str, bytes], rejected_below: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    languages, sizer = list(dictionaries), Sizer(dictionaries)
    for batch in batches:
        preds, scores = [], []
        for raw in texts(batch["text"]):
            if not languages or not has_letter(raw):
                preds.append("und"), scores.append(0.0)
                continue
            sizes = np.array(sizer.sizes(folded(raw)))
            best = int(np.argmin(sizes))
            runner_up = np.delete(sizes, best).min() if len(sizes) > 1 else 2 * sizes[best]
            preds.append(languages[best]), scores.append(float(1 - sizes[best] / max(1, runner_up)))
        yield pa.RecordBatch.from_arrays(
            [batch["rest"], pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
             pa.array([p != "und" and s >= rejected_below for p, s in zip(preds, scores)], pa.bool_())], names)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` without its text, and lang_pred, score (the margin, 0 to 1) and accepted."""
    found = ["lang_pred", "score", "accepted"]
    rest = rest_of(docs, text, *found)
    kind = docs.select(rest.alias("rest")).schema["rest"].dataType.simpleString()
    done = docs.select(rest.alias("rest"), F.col(f"`{text}`").alias("text")).mapInArrow(
        lambda b: _judged(b, dictionaries, margin, ["rest", *found]),
        f"rest {kind}, lang_pred string, score double, accepted boolean")
    return unrest(done, [c for c in docs.columns if c != text], found)


def languages(docs: DataFrame, text: str = "text", id_: str = "doc_id", lang: str = "lang") -> DataFrame:
    """Every row's id with held_out, lang_pred, score and accepted; learns from rows outside the held-out quarter only."""
    known = docs.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    dictionaries = learn(known.where(F.col("id").isNotNull() & (fold("id", 4) != 2)))
    held_out = F.coalesce(fold(id_, 4) == 2, F.lit(True))
    return identify(docs.select(F.col(f"`{id_}`"), held_out.alias("held_out"), F.col(f"`{text}`").alias("text")), dictionaries)
