"""The queries of this subpackage and their SQL, as __spark_entry__.py registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chatformat import OP2_SQL, op2_chat_format
from .editembed import op8_edit_embedding, op8_near_texts
from .htmltext import op7_html_trees
from .langid import op9_langid
from .linefreq import OP3_SQL, op3_line_frequency
from .mixing import OP10_SQL, op10_mixing
from .packing import op5_packing
from .pii import op4_pii_crf
from .simhash import op1_simhash_golay
from .weaklabel import op6_weak_labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_golay": op1_simhash_golay,
    "op10_mixing": op10_mixing,
    "op9_langid": op9_langid,
    "op3_line_frequency": op3_line_frequency,
    "op2_chat_format": op2_chat_format,
    "op8_edit_embedding": op8_edit_embedding,
    "op8_near_texts": op8_near_texts,
    "op4_pii_crf": op4_pii_crf,
    "op5_packing": op5_packing,
    "op6_weak_labels": op6_weak_labels,
    "op7_html_trees": op7_html_trees,
}

ORACLES: dict[str, str] = {
    "op10_mixing": OP10_SQL,
    "op3_line_frequency": OP3_SQL,
    "op2_chat_format": OP2_SQL,
}
