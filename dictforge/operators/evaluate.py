"""Prompts for a trained model and its answers, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictforge.config import INST_FORMAT, SYSTEM_PROMPT, Config
from dictforge.functions import text as T
from dictforge.operators.skew import salted_join

# Fixed value: model family that is prompted in its own fixed form.
FIXED_FORM_FAMILY = "sarvam-1"


def inference_prompt(prompt: Column, cfg: Config, model_id: str | None = None) -> Column:
    """Template up to the answer, filled with system text and prompt."""
    wanted = cfg.model_id if model_id is None else model_id
    if FIXED_FORM_FAMILY in wanted.lower():
        return F.concat(F.lit(f"<s>[INST] <<SYS>>\n{SYSTEM_PROMPT}\n<</SYS>>\n\n"), prompt, F.lit(" [/INST]"))
    head = cfg.templates.get(wanted, INST_FORMAT).split("{target}")[0]
    return T.render(head, user_prompt=F.concat(F.lit(SYSTEM_PROMPT), prompt))


def clean_response(response: Column, prompt: Column, closing: str) -> Column:
    """Answer without the closing mark and without the repeated prompt."""
    text = F.replace(response, F.lit(closing), F.lit("")) if closing else response
    rest = F.substring(text, F.length(prompt) + 1, F.length(text))
    return T.strip(F.when(F.startswith(text, prompt), rest).otherwise(text))


def compare_answers(
    base: DataFrame, tuned: DataFrame, key: str = "prompt", order: str = "timestamp"
) -> DataFrame:
    """Every tuned answer beside the latest base answer to the same prompt.

    The base side is reduced to one row per prompt first, so repeated prompts do not multiply.
    """
    latest = base.groupBy(key).agg(F.max_by("response", order).alias("response_base"))
    return salted_join(tuned, latest, key)
