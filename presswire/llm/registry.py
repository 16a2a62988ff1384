"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from presswire.llm import (
    decontaminate, hardnegatives, htmltext, langcrf, linededup, lmscore, mixing, pivotcodes, shingletree, suffixdup, tokencount, tokenfiles, vectordup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffixdup": suffixdup.op1_suffixdup,
        "op2_mixing": mixing.op2_mixing,
        "op3_decontaminate": decontaminate.op3_decontaminate,
        "op4_htmltext": htmltext.op4_htmltext,
        "op5_language": langcrf.op5_language,
        "op6_shingletree": shingletree.op6_shingletree,
        "op7_tokenfiles": tokenfiles.op7_tokenfiles,
        "op8_tokencount": tokencount.op8_tokencount,
        "op9_lmscore": lmscore.op9_lmscore,
        "op10_vectordup": vectordup.op10_vectordup,
        "op11_hardnegatives": hardnegatives.op11_hardnegatives,
        "op12_pivotcodes": pivotcodes.op12_pivotcodes,
        "op13_linededup": linededup.op13_linededup,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    given = {
        "op1_suffixdup": suffixdup.ORACLE,
        "op3_decontaminate": decontaminate.ORACLE,
        "op6_shingletree": shingletree.ORACLE,
        "op10_vectordup": vectordup.ORACLE,
        "op11_hardnegatives": hardnegatives.ORACLE,
        "op12_pivotcodes": pivotcodes.ORACLE,
        "op13_linededup": linededup.ORACLE,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: sql for name, sql in given.items() if sql}
