"""Operator 12 -- fill-in-middle transformation on SWAR words.

A text is a run of units, ``[A-Za-z]+|[^A-Za-z]`` over code points; it is cut after two of them into prefix, middle and
suffix, and written as ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm).  Texts that hold one
of the marks, empty texts and a tenth of the others stay plain.

Nothing walks over the code points: the UTF-8 bytes of a chunk of texts, each padded with 1 to 8 zero bytes, are seen as
little-endian 64-bit words.  Eight bytes at a time, additions that cannot carry from byte to byte mark ASCII letters and
continuation bytes in the high bits; a unit ends at a byte whose successor is no continuation byte and where not both are
letters.  ``bitwise_count`` gives the units of each word and a running sum those up to it; the k-th end is found by
searching that sum for its word and then, within the word, by a multiplication that adds up the marks of the bytes below.

Plan: one narrow ``mapInArrow`` over bounded chunks of text, no shuffle; the text rebuilt from output and form is made by
Spark functions from the marks alone.

Edge cases: a null text is empty; an empty text is plain with 0 units; a null id draws as the text ``1:``; texts of any
length are handled whole (a longer text than a chunk is a chunk of its own); repeated rows give the same row again, as all draws depend on
the id only; there are no ties to break; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import byte_texts, map_text

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONES = np.uint64(0x0101010101010101)
_CASE = np.uint64(0x2020202020202020)
_FROM_A = np.uint64(0x1F1F1F1F1F1F1F1F)     # 0x80 - ord("a")
_PAST_Z = np.uint64(0x0505050505050505)     # 0x80 - ord("z") - 1
_ONE, _SEVEN, _EIGHT, _TOP = np.uint64(1), np.uint64(7), np.uint64(8), np.uint64(56)


def _following(marks: np.ndarray) -> np.ndarray:
    """The mark of the next byte, at each byte."""
    out = marks >> _EIGHT
    out[:-1] |= marks[1:] << _TOP
    return out


class Units:
    """Unit ends and code points of a list of UTF-8 texts, by rank and by place."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.words = self.sizes // 8 + 1                    # at least one zero byte after each text
        self.first = np.concatenate(([0], np.cumsum(self.words)))
        buf = b"".join(t.ljust(8 * w, b"\0") for t, w in zip(texts, self.words.tolist()))
        x = np.frombuffer(buf, dtype="<u8")
        folded = (x & _LOW7) | _CASE
        letter = (folded + _FROM_A) & ~(folded + _PAST_Z) & ~x & _HIGH
        follows = x & ~(x << _ONE) & _HIGH                  # 10xxxxxx
        ends = _HIGH & ~_following(follows) & ~(letter & _following(letter))
        starts = _HIGH & ~follows
        padding = 8 * self.words - self.sizes               # 1 to 8 bytes at the end of each text's last word
        inside = np.where(padding < 8, np.uint64(0xFFFFFFFFFFFFFFFF) >> (_EIGHT * (padding % 8).astype(np.uint64)), np.uint64(0))
        last = self.first[1:] - 1
        ends[last] &= inside
        starts[last] &= inside
        self.ends, self.starts = ends, starts
        self.up_to = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
        self.points = np.cumsum(np.bitwise_count(starts), dtype=np.int64)

    def _before(self, sums: np.ndarray, word: np.ndarray) -> np.ndarray:
        return np.where(word > 0, sums[word - 1], 0)

    def counts(self) -> np.ndarray:
        """Units of each text."""
        return self._before(self.up_to, self.first[1:]) - self._before(self.up_to, self.first[:-1])

    def cut(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and code points of each text up to the end of its unit number ``rank`` (0: none)."""
        base = self._before(self.up_to, self.first[:-1])
        wanted = base + rank
        word = np.searchsorted(self.up_to, np.maximum(wanted, 1), side="left")
        some = rank > 0
        word = np.where(some, word, self.first[:-1])
        inner = np.where(some, wanted - self._before(self.up_to, word), 1).astype(np.uint64)     # 1 to 8
        below = (self.ends[word] >> _SEVEN) * _ONES         # byte j: marks in the bytes 0 to j
        reached = ((below | _HIGH) - inner * _ONES) & _HIGH
        byte = 8 - np.bitwise_count(reached).astype(np.int64)
        size = np.where(some, 8 * (word - self.first[:-1]) + byte + 1, 0)
        part = np.uint64(0xFFFFFFFFFFFFFFFF) >> (_EIGHT * (7 - np.minimum(byte, 7)).astype(np.uint64))
        points = self._before(self.points, word) - self._before(self.points, self.first[:-1]) + np.bitwise_count(self.starts[word] & part)
        return size, np.where(some, points, 0)


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """The four draws of a document: the first four groups of eight digits of the hex sha256 of ``1:`` and the id."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and the output text."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def step(chunk: pa.RecordBatch) -> dict:
        texts = byte_texts(chunk)
        units = Units(texts)
        n = units.counts()
        h = np.array([draws(d) for d in chunk.column("doc_id").to_pylist()], dtype=np.int64).reshape(-1, 4)
        one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
        (a, a_points), (b, b_points) = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
        plain = h[:, 2] % 100 >= 100 - PLAIN_PERCENT
        form, out = [], []
        for k, t in enumerate(texts):
            if plain[k] or not t or PREFIX in t or SUFFIX in t or MIDDLE in t:
                form.append("plain")
                out.append(t)
                continue
            prefix, middle, suffix = t[:a[k]], t[a[k]:b[k]], t[b[k]:]
            if h[k, 3] % 100 < SPM_PERCENT:
                form.append("spm")
                out.append(b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)))
            else:
                form.append("psm")
                out.append(b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
        none = np.array([f == "plain" for f in form], dtype=bool)
        return {"doc_id": chunk.column("doc_id"), "n": n, "form": form, "prefix_chars": pa.array(a_points, mask=none),
                "middle_chars": pa.array(b_points - a_points, mask=none), "output": pa.array(out, pa.binary()).cast(pa.string())}

    return map_text(rows, step, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output="output", form="form"):
    """The source text as a column, from an output and its form: texts that are cut hold no mark and no mark overlaps
    another, so the first occurrence of each is the one written."""
    out, form = F.col(output), F.col(form)

    def part(mark: bytes, number: int):
        return F.split_part(out, F.lit(mark.decode()), F.lit(number))

    middle = part(MIDDLE, 2)
    body = part(MIDDLE, 1)

    def piece(mark: bytes, number: int):
        return F.split_part(body, F.lit(mark.decode()), F.lit(number))

    psm = F.concat(F.substr(piece(SUFFIX, 1), F.lit(4)), middle, piece(SUFFIX, 2))
    spm = F.concat(piece(PREFIX, 2), middle, F.substr(piece(PREFIX, 1), F.lit(4)))
    return F.when(form == "plain", out).when(form == "psm", psm).otherwise(spm)


def digests(rows: DataFrame) -> DataFrame:
    """The contract's columns from ``transform``'s rows."""
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, n, t, array_to_string(u[1 : least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1 : greatest(h1, h2)], '') AS m,
         array_to_string(u[greatest(h1, h2) + 1 :], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""
