"""Problem 2: splitting oversized items at natural boundaries.

Balanced targets: the minimum number of pieces is computed, equal-length targets are placed, each is snapped to
the strongest boundary near it, and a piece is added whenever a limit fails; targets are balanced anew after each cut. Consecutive pieces share exactly
`overlap` characters; only a stretch without any white space forces a cut inside a word.

Positions and lengths count Unicode code points. Null and empty texts give no pieces, texts up to the limit one.
Repeated rows give repeated pieces, which p2_found reports once; columns besides id and text are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import flat_map, table

LIMIT, OVERLAP = 1800, 200
PARAGRAPH, SENTENCE, CLAUSE, WORD = 4.0, 3.0, 2.0, 1.0  # strengths of boundaries
_BREAKS = re.compile(r"(?P<p>\s*\n\s*\n\s*)|(?P<s>[.!?।॥。！？۔؟…][\"'”’»)\]」』]*(?:\s+|(?<=[。！？」』])))|(?P<c>(?:[,;:،؛、，；：](?:\s+|(?<=[、，；：])))|\s*\n\s*)|(?P<w>\s+)")
_STRETCH = re.compile(r"\S+")


def boundaries(text: str) -> tuple[list[int], list[float]]:
    """Ends at which a piece may stop (before the white space that follows), with their strengths."""
    at, strength = [], []
    for m in _BREAKS.finditer(text):
        kind = m.lastgroup
        if kind in ("s", "c"):
            end = m.start() + len(m.group().rstrip())
        else:
            end = m.start()
        if end > 0 and (not at or end > at[-1]):
            at.append(end)
            strength.append({"p": PARAGRAPH, "s": SENTENCE, "c": CLAUSE, "w": WORD}[kind])
    return at, strength


def plan(n: int, at: list[int], strength: list[float], limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces, 0-based and half-open.

    Each cut is planned from where the last one fell, so a stretch without boundaries costs the balance of no other part.
    """
    if n <= limit:
        return [(0, n)] if n else []
    # boundaries that a stretch too long to be skipped follows: up to each the pieces are balanced by themselves
    walls = [x for x, y in zip(at, [*at[1:], n]) if y - x > limit - overlap]
    pieces, start = [], 0
    while n - start > limit:
        k = bisect_right(walls, start + overlap)
        end = snapped(walls[k] if k < len(walls) else n, start, at, strength, limit, overlap)
        pieces.append((start, end))
        start = end - overlap
    pieces.append((start, n))
    return pieces


def snapped(n: int, start: int, at: list[int], strength: list[float], limit: int, overlap: int) -> int:
    """End of the piece at start, of a text that is to be cut up to n: the strongest boundary near the balanced target.

    If no boundary is near, pieces are added; where no number of pieces helps, the last boundary within reach is
    taken, without any the limit.
    """
    if n - start <= limit:
        return n
    step = limit - overlap
    least = -(-(n - start - overlap) // step)
    for left in range(least, 2 * least + 2):
        target = start + overlap + (n - start - overlap) / left
        reach = step / 2
        low = max(start + overlap + 1, int(target - reach), n - (left - 1) * step)
        high = min(start + limit, int(target + reach))
        i, j = bisect_left(at, low), bisect_right(at, high)
        if i < j:
            best = max(range(i, j), key=lambda k: (strength[k] - 3 * abs(at[k] - target) / reach, -at[k]))
            return at[best]
        if target - reach <= start + overlap + 1:  # all that is in reach has been tried
            break
    j = bisect_right(at, start + limit) - 1
    return at[j] if j >= 0 and at[j] > start + overlap else start + limit


def is_forced(text: str, pieces: list[tuple[int, int]], limit: int) -> bool:
    """Whether a cut lies inside a stretch without white space that is longer than the limit; every such stretch holds one."""
    long = [m.span() for m in _STRETCH.finditer(text) if m.end() - m.start() > limit]
    return any(a < end < b for _, end in pieces[:-1] for a, b in long)


def split_text(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece: id, piece_no from 1, start_pos from 1, piece, cut ('whole', 'natural' or 'forced').

    cut is 'forced' if a piece had to end inside a stretch without white space that is longer than the limit, else 'natural'.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        def step(key, text) -> Iterator[tuple]:
            if len(text) <= limit:
                yield key, 1, 1, text, "whole"
                return
            pieces = plan(len(text), *boundaries(text), limit, overlap)
            cut = "forced" if is_forced(text, pieces, limit) else "natural"
            for i, (a, b) in enumerate(pieces, 1):
                yield key, i, a + 1, text[a:b], cut

        return step

    rows = df.select(id_col, text_col).filter(F.length(text_col) > 0)
    return flat_map(rows, make, f"{id_col} {kind}, piece_no int, start_pos int, piece string, cut string")


def p2_pieces(spark, sf_dir: str) -> DataFrame:
    return split_text(table(spark, sf_dir, "sheet2"), "record_id", "spell_corrected_text").distinct()


def p2_found(spark, sf_dir: str) -> DataFrame:
    long = table(spark, sf_dir, "sheet2").filter(F.length("spell_corrected_text") > LIMIT)
    pieces = split_text(long, "record_id", "spell_corrected_text")
    return pieces.filter("piece_no = 1").select("record_id", "cut").distinct()


def p2_rejoined(spark, sf_dir: str) -> DataFrame:
    """Round trip: the MD5 of each text put together again from its pieces, without what they share; and the longest piece under the limit."""
    pieces = p2_pieces(spark, sf_dir).filter("record_id IS NOT NULL")
    own = F.when(F.col("piece_no") == 1, F.col("piece")).otherwise(F.substring("piece", OVERLAP + 1, LIMIT))
    whole = pieces.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", own.alias("own")))).alias("p"), F.max(F.length("piece")).alias("longest"))
    return whole.select("record_id", F.md5(F.array_join(F.transform("p", lambda x: x["own"]), "").cast("binary")).alias("text_md5"), (F.col("longest") <= LIMIT).alias("within_limit"))


QUERIES = {"p2_found": p2_found, "p2_pieces": p2_pieces, "p2_rejoined": p2_rejoined}
ORACLES = {
    "p2_rejoined": "SELECT DISTINCT record_id, md5(spell_corrected_text) AS text_md5, true AS within_limit FROM sheet2 WHERE record_id IS NOT NULL AND length(spell_corrected_text) > 0",
    "p2_found": r"""
        SELECT DISTINCT record_id,
               CASE WHEN list_max(list_transform(regexp_split_to_array(spell_corrected_text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+'), lambda w: length(w))) > 1800
                    THEN 'forced' ELSE 'natural' END AS cut
        FROM sheet2 WHERE length(spell_corrected_text) > 1800""",
}
