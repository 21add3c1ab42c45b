"""Fill-in-the-middle transformation over code points.

A text is decoded to an array of UTF-32 code points. Each code point has a class (other, space, line
end); a unit ends wherever the classes of two neighbours say so (``UNITS``), so one comparison of the class
array with itself, shifted by one, and ``flatnonzero`` give all unit borders. Two keyed draws pick the
ranks of the borders between prefix, middle and suffix; the three slices are encoded again and put in
order around sentinels. ``restored`` undoes it with columns alone.

The draws come from the document's id and the seed, so a run can be repeated, and rows that repeat a doc_id are cut at
ranks from the same draws. The pass is narrow: no shuffle, memory of some copies of the text at hand.

Defined cases: null and empty texts have no units and stay plain (n = 0, output empty); a text that holds a
sentinel stays plain, so that what is restored is exact; a null doc_id draws as the word ``null``; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import draw_seed, keyed_draws, texts, tuned, unkey

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OTHER, SPACE, END = range(3)
#: For each kind of unit: may a unit end between a code point of the row's class and one of the column's?
UNITS = {
    "line": np.array([[0, 0, 0], [0, 0, 0], [1, 1, 1]], bool),
    "word": np.array([[0, 0, 0], [1, 0, 0], [1, 0, 0]], bool),
    "char": np.ones((3, 3), bool),
}
_SPACES = np.array([9, 11, 12, 13, 32], np.uint32)


def borders(points: np.ndarray, unit: str) -> np.ndarray:
    """0, the ends of all units but the last, and the number of code points; only 0 for an empty text."""
    if not len(points):
        return np.zeros(1, np.int64)
    kind = np.isin(points, _SPACES).astype(np.int8)
    kind[points == 10] = END
    inner = np.flatnonzero(UNITS[unit][kind[:-1], kind[1:]]) + 1
    return np.concatenate([[0], inner, [len(points)]])


def cut(text: str, unit: str, ranks: tuple[int, int]) -> tuple[int, str, str, str]:
    """(units, prefix, middle, suffix): ranks are reduced modulo the number of borders."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    at = borders(points, unit)
    low, high = sorted(r % len(at) for r in ranks)
    piece = lambda a, z: points[a:z].tobytes().decode("utf-32-le", "surrogatepass")
    return len(at) - 1, piece(0, at[low]), piece(at[low], at[high]), piece(at[high], len(points))


def transform(docs: DataFrame, unit: str = "line", rate: int = 100, spm_rate: int = 50, seed: int = 7) -> DataFrame:
    """Per row: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output. ``rate`` of 100
    texts are transformed, ``spm_rate`` of 100 of those with the suffix first."""
    tuned(docs.sparkSession)

    def run(batches):
        for b in batches:
            rows = []
            for text, *h in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                n, prefix, middle, suffix = cut(text, unit, (h[0], h[1]))
                if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= rate:
                    rows.append((n, "plain", None, None, text))
                elif h[3] % 100 < spm_rate:
                    rows.append((n, "spm", len(prefix), len(middle), "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))))
                else:
                    rows.append((n, "psm", len(prefix), len(middle), "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))))
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    drawn = texts(docs).select("doc_id", "text", *keyed_draws(draw_seed(seed, unkey("doc_id")), 4))
    out = drawn.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.select(unkey("doc_id"), *out.columns[1:])


def restored(form: str = "form", output: str = "output") -> Column:
    """The original text, from a form and an output: each sentinel stands once in an output that is not plain."""
    body, mark = F.expr(f"substring({output}, {len(PREFIX) + 1})"), F.lit(MIDDLE)
    part = lambda text, by, k: F.split_part(text, F.lit(by) if isinstance(by, str) else by, F.lit(k))
    middle = part(body, mark, 2)
    psm = F.concat(part(body, SUFFIX, 1), middle, part(part(body, SUFFIX, 2), mark, 1))
    spm = F.concat(part(part(body, PREFIX, 2), mark, 1), middle, part(body, PREFIX, 1))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def digests(docs: DataFrame) -> DataFrame:
    """``transform`` by lines with digests of the output and of the text that is restored from it."""
    out = transform(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS w, sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
h AS (
  SELECT doc_id, t, w, len(w)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(w) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(w) + 1) AS b,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS d FROM u),
p AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 100 THEN 'plain' WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(w[1:least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1:n], '') AS s FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM p
"""
