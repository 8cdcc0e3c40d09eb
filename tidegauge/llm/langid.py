"""Language identification by compression with per-language dictionaries.

For each language a dictionary of sample text is kept. A text is cut into blocks; each block is compressed with every
dictionary (zstandard, raw-content dictionaries), and the language with the smallest total wins: a block shrinks most
where its words are already in the dictionary. A text whose best two totals are too close is rejected.

Rows: a NULL text, one without a letter, or an empty set of learned languages gives ``und`` with score 0, rejected; ties
go to the first language by name and are rejected; very long texts are compressed whole, block by block; repeated rows
are judged alike; an empty table gives no rows; further columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import small_batches

LEVEL = 6
BLOCK = 2048
#: Blocks below the first size are repeated up to the second: a tiny block alone is stored, not compressed.
SHORT, FILLED = 128, 256
#: Bytes of a dictionary, and the texts of a language it is taken from at most: those of ``GOOD_LENGTHS`` first, then by
#: a hash of the text. This is the bounded sample the classifier is fitted on.
DICTIONARY = 110_000
SAMPLE_TEXTS = 150
GOOD_LENGTHS = (200, 4_000)
#: Rejected: the second-best total is not larger than the best by this share of it.
MARGIN = 0.004
#: How fast the share of a language falls with its excess size.
SHARPNESS = 60.0

ANSWER = "lang_pred string, score double, margin double, rejected boolean"


def dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """The dictionary of each ``lang`` of (text, lang); one per language comes to the driver."""
    size = F.char_length("text")
    order = Window.partitionBy("lang").orderBy((~size.between(*GOOD_LENGTHS)).cast("int"), F.xxhash64("text"), "text")
    sample = (
        labelled.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select("lang", "text")
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_TEXTS)
    )

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = pdf.sort_values("rank")["text"]
        content = "\n".join(t.lower() for t in texts).encode()[:DICTIONARY]
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "content": [content]})

    return {r.lang: bytes(r.content) for r in sample.groupBy("lang").applyInPandas(join, "lang string, content binary").collect()}


class Classifier:
    def __init__(self, contents: dict[str, bytes]):
        import zstandard

        self.languages = sorted(contents)
        self.compressors = []
        for lang in self.languages:
            held = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
            ))

    def sizes(self, text: str) -> np.ndarray:
        data = text.lower().encode()
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        blocks = [b if len(b) >= SHORT else b * -(-FILLED // len(b)) for b in blocks]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self.compressors], np.float64)

    def judge(self, text: str | None) -> tuple[str, float, float, bool]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0, True
        sizes = self.sizes(text)
        best = int(np.argmin(sizes))
        rest = np.delete(sizes, best)
        margin = float((rest.min() - sizes[best]) / rest.min()) if len(rest) else 1.0
        share = 1 / (1 + np.exp(-SHARPNESS * (rest / sizes[best] - 1)).sum())
        return self.languages[best], float(share), margin, margin < MARGIN


def language_of(text: Column, contents: dict[str, bytes]) -> Column:
    """A struct (lang_pred, score, margin, rejected) for each text."""
    @F.pandas_udf(ANSWER)
    def answer(texts: pd.Series) -> pd.DataFrame:
        judge = Classifier(contents).judge
        return pd.DataFrame([judge(t) for t in texts], columns=["lang_pred", "score", "margin", "rejected"])

    return answer(text)


def with_language(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``language`` learned from ``labelled`` (text, lang)."""
    contents = dictionaries(labelled)
    small_batches(docs.sparkSession, 2048)
    return docs.withColumn("language", language_of(F.col("text"), contents))
