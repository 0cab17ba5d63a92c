"""Fill-in-middle transformation of texts.

The tokenizers library's Split pre-tokenizer, with a pattern whose matches stand alone,
cuts a text into units and gives their offsets in code points; nothing is trained. The
number of offsets is n. Two of the n + 1 borders between units are drawn by the text's
own hash and ranked: the smaller ends the prefix, the larger the middle. Only n and
the two offsets come back from Python; texts are sliced and put together by Spark.

Forms: psm is prefix, suffix, middle; spm is suffix, prefix, middle; each part follows its
sentinel. Texts that hold a sentinel stay plain, so a form can always be taken apart.

Cases: a null text is the empty text; the empty text is plain, with n = 0; bytes that
aren't UTF-8 are U+FFFD; a null id draws as the empty string does; rows with one id and one
text have one result, rows with one id share their draws; very long texts are cut as a
whole; an empty table gives an empty result; further columns stay, whatever their names,
but for one named as ``out``, whose place the result takes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.store import small_batches, whole_text

#: The sentinels of prefix, suffix and middle, and the units of a text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LINES = r"[^\n]*\n|[^\n]+"


def draws(id_: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def cuts(text: Column, first: Column, second: Column, pattern: str = LINES) -> Column:
    """Struct (n, low, high): the units of a text, and the code-point offsets where prefix and middle end."""

    @F.arrow_udf("struct<n:long,low:long,high:long>")
    def of(texts: pa.Array, firsts: pa.Array, seconds: pa.Array) -> pa.Array:
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        split = Split(Regex(pattern), behavior="isolated")
        out = []
        for t, *drawn in zip(texts.to_pylist(), firsts.to_pylist(), seconds.to_pylist(), strict=True):
            borders = np.array([0, *(end for _, (_, end) in split.pre_tokenize_str(t))], np.int64)
            low, high = sorted(int(borders[d % borders.size]) for d in drawn)
            out.append((borders.size - 1, low, high))
        columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(3)]
        return pa.StructArray.from_arrays(columns, names=["n", "low", "high"])

    return of(text, first, second)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made of."""
    between = lambda left, right: F.substring_index(F.substring_index(output, right, 1), left, -1)
    last = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), last, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), last, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50,
    pattern: str = LINES, out: str = "__fim",
) -> DataFrame:
    """``docs`` with a column ``out``: struct of n, form, prefix_chars, middle_chars (null if plain) and output.

    Of a hundred texts ``rate`` are transformed, and of those ``spm_rate`` suffix first."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("doc"), whole_text(F.col(text_col)).alias("text"), *[d.alias(f"h{k}") for k, d in enumerate(draws(F.col(id_col), seed))])
    rows = rows.select("doc", "text", "h2", "h3", cuts(F.col("text"), F.col("h0"), F.col("h1"), pattern).alias("cut"))
    text, low, high = F.col("text"), F.col("cut.low"), F.col("cut.high")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (F.col("h2") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h3") % 100 < spm_rate, "spm").otherwise("psm")
    part = lambda start, length: text.substr(start.cast("int"), length.cast("int"))
    rows = rows.select("doc", "text", "cut", form.alias("form"), part(F.lit(1), low).alias("prefix"), part(low + 1, high - low).alias("middle"), part(high + 1, F.length(text) - high).alias("suffix"))
    whole = lambda *parts: F.concat(*[x for mark, name in parts for x in (F.lit(mark), F.col(name))])
    psm = whole((PREFIX, "prefix"), (SUFFIX, "suffix"), (MIDDLE, "middle"))
    spm = whole((SUFFIX, "suffix"), (PREFIX, "prefix"), (MIDDLE, "middle"))
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    told = lambda chars: F.when(F.col("form") != "plain", chars)
    made = F.struct(F.col("cut.n").alias("n"), "form", told(low).alias("prefix_chars"), told(high - low).alias("middle_chars"), output.alias("output"))
    stay = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() != out.lower()]
    return rows.select(*stay, made.alias(out))
