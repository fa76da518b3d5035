"""Fill-in-the-middle texts, cut through a sparse index of multibyte characters."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode())
CHANGED, SUFFIX_FIRST = 90, 20
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class CharIndex:
    """Byte and code-point offsets of UTF-8 text from its multibyte characters alone.

    ``at`` holds the byte positions of these characters, ``excess`` the bytes beyond one for
    each character up to and including the i-th. Offsets in ASCII spans are differences.
    """

    def __init__(self, data: np.ndarray):
        lead = np.flatnonzero(data >= 0xC0)
        self.at = lead
        self.excess = np.concatenate([[0], np.cumsum(1 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0))])
        # Code-point positions of the same characters.
        self.char_at = lead - self.excess[:-1]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before byte offsets that lie on character bounds."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Byte offsets of code-point offsets."""
        return char + self.excess[np.searchsorted(self.char_at, char)]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Byte offsets of the units: runs of ASCII letters, or one other character."""
    letter = LETTER[data]
    goes_on = np.concatenate([[False], letter[:-1]]) & letter
    return np.flatnonzero(((data & 0xC0) != 0x80) & ~goes_on)


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def rearranged(doc_id: int | None, text: bytes, seed: int) -> tuple:
    """n, form, prefix_chars, middle_chars and the output of one text in UTF-8."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts = unit_starts(data)
    n = len(starts)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= CHANGED or any(mark in text for mark in MARKS):
        return n, "plain", None, None, text
    ends = np.append(starts, len(data))
    cuts = ends[sorted((h1 % (n + 1), h2 % (n + 1)))]
    first, second = CharIndex(data).chars(cuts).tolist()
    low, high = cuts.tolist()
    head, middle, tail = text[:low], text[low:high], text[high:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", first, second - first, MARKS[1] + tail + MARKS[0] + head + MARKS[2] + middle
    return n, "psm", first, second - first, MARKS[0] + head + MARKS[1] + tail + MARKS[2] + middle


def infilled(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row of ``docs`` (doc_id, text).

    Cuts and form come from a hash of ``seed`` and doc_id, so that reruns and retries agree;
    rows that repeat a doc_id are cut by the same numbers, a null doc_id hashes as an empty
    text. ``n`` counts the units. ``form`` is plain (as it is, the only form of null, empty or
    marked texts), psm or spm; lengths are in code points and null if plain. Whole texts are
    handled one at a time. Further columns are ignored; an empty table gives no rows.
    """
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text in zip(frame.doc_id, frame.text):
                *numbers, output = rearranged(doc_id, text.encode(errors="replace"), seed)
                out.append((doc_id, *numbers, output.decode()))
            doc_ids, n, form, prefix, middle, output = zip(*out) if out else [()] * 6
            yield pd.DataFrame({
                "doc_id": doc_ids, "n": n, "form": form, "prefix_chars": pd.array(prefix, dtype="Int64"),
                "middle_chars": pd.array(middle, dtype="Int64"), "output": output})

    # Ids travel as text: whole numbers beside nulls would pass through doubles.
    given = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    made = given.mapInPandas(work, SCHEMA.replace("doc_id long", "doc_id string"))
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``infilled`` made an output of."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    piece = lambda i: F.get(part, F.lit(i))
    return (F.when(form == "psm", F.concat(piece(1), piece(3), piece(2)))
            .when(form == "spm", F.concat(piece(2), piece(3), piece(1))).otherwise(output))
