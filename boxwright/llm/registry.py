"""Queries of this folder: name -> (spark, sf_dir) -> DataFrame, and SQL where it can say the same."""

from __future__ import annotations

from .token_records import op10_token_records
from .decontaminate import op6_decontamination
from .language_id import op3_language_id
from .line_dedup import op1_line_dedup
from .pitman_yor import op4_pitman_yor
from .sentencepieces import op5_sentencepiece
from .tiff import op7_tiff
from .toxicity import op8_toxicity
from .warc import OP9_SQL, op9_warc_content_addressed
from .near_dedup import OP2_SQL, op2_minhash_near_dedup

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_pitman_yor": op4_pitman_yor,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_decontamination": op6_decontamination,
    "op7_tiff": op7_tiff,
    "op8_toxicity": op8_toxicity,
    "op9_warc_content_addressed": op9_warc_content_addressed,
    "op10_token_records": op10_token_records,
}
SQL = {
    "op2_minhash_near_dedup": OP2_SQL,
    "op9_warc_content_addressed": OP9_SQL,
}
