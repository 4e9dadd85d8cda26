"""Bounded samples for fitting models, and small helpers shared by the text operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of the sampling hash.
HASH_BUCKETS = 1 << 20
#: Longer texts are no sample texts, so that a sample stays small in memory.
MOST_OCTETS = 20_000


def bounded_sample(df: DataFrame, key: str, rows: int) -> pd.DataFrame:
    """About ``rows`` rows, never more than twice that, chosen by a hash of ``key`` so that every run and every
    partitioning picks the same ones. Only models are fitted on it; no result is computed from it."""
    if "text" in df.columns:
        df = df.where(F.octet_length("text") <= MOST_OCTETS)
    total = df.count()
    if total == 0:
        return df.limit(0).toPandas()
    share = min(1.0, 1.2 * rows / total)
    place = F.xxhash64(F.lit(17), F.col(key))
    chosen = df.where(F.pmod(place, F.lit(HASH_BUCKETS)) < F.lit(int(share * HASH_BUCKETS) + 1))
    return chosen.orderBy(place, key).limit(2 * rows).toPandas()


#: Names and codes met in language labels, by ISO 639-1 code.
LANGUAGE_NAMES = {
    "en": "en eng english", "de": "de deu ger german deutsch", "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano", "it": "it ita italian italiano",
    "pt": "pt por portuguese português portugues", "ru": "ru rus russian русский", "zh": "zh zho chi chinese 中文 cmn",
    "ja": "ja jpn japanese 日本語", "th": "th tha thai", "hi": "hi hin hindi",
}
CODE_OF = {word: code for code, words in LANGUAGE_NAMES.items() for word in words.split()}


def normalized_label(label: str | None) -> str | None:
    """ISO 639-1 code of a label in any notation (name, two or three letters, region, case); None if it says nothing."""
    if label is None:
        return None
    head = label.strip().lower().replace("_", "-").split("-")[0].strip()
    return CODE_OF.get(head)
