"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised (lower case, ASCII punctuation and white space become one space). A benchmark
item of m characters may occur with up to e = floor(rate * m) edits. It is cut into e + 1 pieces: an
occurrence with e edits leaves one piece untouched, so an exact search for all pieces (one automaton)
finds a spot in every occurrence. Around each such spot Myers' bit-parallel algorithm measures the
edit distance of the whole item. No occurrence within the budget is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowatch.llm.common import free_name, matching_rows, stored, tidy, worker_cache

ERROR_RATE = 0.07
# Normalised items that go to the tasks at once; a larger benchmark takes several passes.
PASS_BYTES = 32 << 20
HITS = "doc_id long, item_id long, distance int, budget int, start long, end long, passage string"

# Space for ASCII white space and punctuation; other bytes stay, so that UTF-8 stays whole.
_SPACED = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def normalised(text: str | None) -> str:
    """Words between single spaces, with a space at either end; empty if there is no word."""
    octets = (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED)
    words = b" ".join(octets.split())
    return f" {words.decode('utf-8', 'surrogatepass')} " if words else ""


def origins(text: str) -> list[int]:
    """For each character of ``normalised(text)``: where it comes from in ``text``."""
    out, gap = [0], False
    for i, ch in enumerate(text):
        low = ch.lower()
        if ch.isascii() and not ch.isalnum():
            gap = len(out) > 1
            continue
        if gap:
            out.append(i - 1)
            gap = False
        out += [i] * len(low)
    return out + [len(text)]


class Items:
    """Benchmark items, the automaton of their pieces, and the bit masks for Myers' algorithm."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.rate, self.items, self.pieces, self.automaton = rate, [], [], None
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            norm = normalised(text)
            if not norm:
                continue
            budget = math.floor(rate * (len(norm) - 2))
            masks: dict[str, int] = {}
            for i, ch in enumerate(norm):
                masks[ch] = masks.get(ch, 0) | 1 << i
            at = len(self.items)
            self.items.append((item_id, norm, budget, masks))
            cuts = [len(norm) * i // (budget + 1) for i in range(budget + 2)]
            for lo, hi in zip(cuts, cuts[1:]):
                where.setdefault(norm[lo:hi], []).append((at, lo))
        if where:
            self.automaton = ahocorasick.Automaton()
            for piece, places in where.items():
                self.automaton.add_word(piece, (len(piece), places))
            self.automaton.make_automaton()

    def occurrences(self, norm: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best occurrence of each item in a normalised text."""
        windows: dict[int, set[int]] = {}
        for last, (length, places) in self.automaton.iter(norm):
            for item, offset in places:
                windows.setdefault(item, set()).add(last + 1 - length - offset)
        found = []
        for item, begins in windows.items():
            _, pattern, budget, masks = self.items[item]
            at = norm.find(pattern)
            if at >= 0:
                found.append((item, 0, at, at + len(pattern)))
                continue
            best, done = None, -1
            for begin in sorted(begins):
                lo, hi = max(begin - budget, 0), min(begin + len(pattern) + budget, len(norm))
                # Spots close together share one stretch; what an earlier one covered is not read again.
                if hi <= done:
                    continue
                done = hi
                hit = myers(norm[lo:hi], masks, len(pattern), budget)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], lo, lo + hit[1])
            if best:
                distance, lo, end = best
                found.append((item, distance, self._start(norm, lo, end, pattern, distance), end))
        return found

    @staticmethod
    def _start(norm: str, lo: int, end: int, pattern: str, distance: int) -> int:
        """Where the occurrence that ends at ``end`` begins: the same search, read backwards."""
        back = pattern[::-1]
        masks: dict[str, int] = {}
        for i, ch in enumerate(back):
            masks[ch] = masks.get(ch, 0) | 1 << i
        hit = myers(norm[lo:end][::-1], masks, len(pattern), distance, anchored=True)
        return end - hit[1] if hit else lo


def myers(text: str, masks: dict[str, int], m: int, budget: int, anchored: bool = False) -> tuple[int, int] | None:
    """Least edit distance of a pattern to any part of ``text``, if within ``budget``, and its end.

    Bit i of the vectors stands for the pattern's i-th character, so a text character costs a few
    operations whatever the pattern's length. ``anchored``: the part begins where the text does.
    """
    if not m:
        return None
    full, top = (1 << m) - 1, 1 << (m - 1)
    # Set bits: where the distance grows (rise) or shrinks (fall) by one along the pattern.
    rise, fall, score, best = full, 0, m, None
    for j, ch in enumerate(text):
        same = masks.get(ch, 0)
        flat = (((same & rise) + rise) ^ rise) | same
        up, down = (fall | ~(flat | rise)) & full, rise & flat
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | anchored) & full, down << 1 & full
        kept = same | fall
        rise, fall = (down | ~(kept | up)) & full, up & kept
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def _find(batches: Iterator[pd.DataFrame], items: Items) -> Iterator[pd.DataFrame]:
    worker_cache("decontamination")  # earlier stages' words are not needed any more
    for batch in batches:
        out = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            norm = normalised(text)
            found = items.occurrences(norm) if norm and items.automaton else []
            if not found:
                continue
            at = origins(text)
            for item, distance, lo, hi in found:
                lo, hi = lo + (norm[lo] == " "), hi - (norm[hi - 1] == " ")
                start, end = at[lo], at[hi - 1] + 1
                item_id, _, budget, _ = items.items[item]
                out.append((None if pd.isna(doc_id) else int(doc_id), item_id, distance, budget, start, end, text[start:end]))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in HITS.split(", ")]).astype({"doc_id": "Int64", "item_id": "Int64"})


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per document row and benchmark item that occurs in it, with the best occurrence.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read.
    Columns: doc_id, item_id, distance (edits), budget, start, end (characters of the text), passage.
    Null and empty texts and items without a word match nothing. Items too short for one edit must
    occur as whole words. Repeated rows are reported each; ids may be null. Of several occurrences
    the one of least distance, then the first, is given.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    weight = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    passes = max(1, -(-weight // PASS_BYTES))
    out = None
    for i in range(passes):
        share = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i)
        sent = spark.sparkContext.broadcast([tuple(r) for r in share.collect()])  # PASS_BYTES on average
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        found = texts.mapInPandas(lambda it, sent=sent: tidy(_find(it, Items(sent.value, rate))), HITS)
        out = found if out is None else out.union(found)
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark item.

    Rows are numbered and stored first, so that each follows its own text, whatever its id.
    """
    number = free_name(docs, "decontam_row")
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    hits = benchmark_hits(rows.select(F.col(number).alias("doc_id"), "text"), benchmark, rate)
    leaks = stored(hits.select("doc_id").distinct(), "leaks")
    return matching_rows(rows, number, leaks, keep=False).select(*docs.columns)
