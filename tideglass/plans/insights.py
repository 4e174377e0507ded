"""KPI rows and ranked movers to insight rows (N1-N7 put together)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from tideglass.config import Preset
from tideglass.operators.kpi import kpi_struct
from tideglass.operators.movers import collect_movers
from tideglass.operators.narrative import (
    TEMPLATE_MODEL, count_prompts, default_insight, display_text, generate, parse_response, prompt,
    sanitize, wants_model,
)
from tideglass.schemas import INSIGHT, MOVER

Respond = Callable[[list[str]], list[str | None]]
Count = Callable[[list[str]], list[int]]


def with_inputs(kpis: DataFrame, ranked_movers: DataFrame) -> DataFrame:
    """One row per window: its KPI record and its movers, an empty list where there are none.
    Windows meet by their dates and type, a free window by its NULL type. Both sides hold a few
    rows per window; neither is broadcast by hand."""
    key = ["insight_date", "insight_type"]
    window = [*key, "window_start", "window_end"]
    lists = collect_movers(ranked_movers).select(
        *[F.col(c).alias(f"of_{c}") for c in window], "top_movers")
    none = F.array().cast(T.ArrayType(MOVER))
    same = F.lit(True)
    for c in window:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return kpis.select(*window, kpi_struct().alias("kpi")).join(lists, same, "left").select(
        *key, "kpi", F.coalesce("top_movers", none).alias("top_movers")
    )


def build_insights(
    inputs: DataFrame,
    preset: Preset,
    respond: Respond | None = None,
    model_name: str = "generator",
    count_tokens: Count | None = None,
) -> DataFrame:
    """Insight rows from ``with_inputs``. Without ``respond`` every row is the template's.
    ``count_tokens`` gives the stored size of prompts that were sent; 0 without it."""
    kpi, rules = F.col("kpi"), preset.text
    period = F.lower("insight_type") if preset.period_in_prompt else None
    template = inputs.select(
        "*", default_insight(kpi).alias("narrative"),
        F.lit(TEMPLATE_MODEL).alias("model_name"),
        F.lit("").alias("raw_prompt"),
        F.lit(0).cast("bigint").alias("prompt_tokens"),
        F.lit(None).cast("string").alias("response"),
    )
    if respond is None:
        rows = template
    else:
        asked = inputs.where(wants_model(kpi, preset.gate)).withColumn(
            "raw_prompt", prompt(kpi, F.col("top_movers"), rules, period)
        )
        asked = count_prompts(asked, count_tokens) if count_tokens is not None \
            else asked.withColumn("prompt_tokens", F.lit(0).cast("bigint"))
        answered = generate(asked, respond).select(
            *inputs.columns, parse_response(F.col("response"), rules).alias("narrative"),
            F.lit(model_name).alias("model_name"), "raw_prompt", "prompt_tokens", "response",
        )
        rows = template.where(~wants_model(kpi, preset.gate)).unionByName(answered)

    narrative = F.col("narrative")
    stored = sanitize(narrative, rules) if rules.tidy_stored else narrative
    # The parsed answer is kept, as an object; the template has none.
    response = F.when(F.col("response").isNull(), F.parse_json(F.lit("{}"))) \
        .otherwise(F.to_variant_object(narrative))
    columns = {
        "insight_date": F.col("insight_date"),
        "insight_type": F.col("insight_type"),
        "window_start": kpi["window_start"],
        "window_end": kpi["window_end"],
        "headline": stored["headline"],
        "bullets": stored["bullets"],
        "actions": stored["actions"],
        "top_movers_used": F.col("top_movers"),
        "kpi_used": kpi,
        "model_name": F.col("model_name"),
        "prompt_tokens": F.col("prompt_tokens"),
        "created_at": F.lit(None).cast("timestamp_ntz"),
        "raw_prompt": F.col("raw_prompt"),
        "raw_response": response,
        "display_text": display_text(narrative, rules),
    }
    return rows.select(*[columns[f.name].alias(f.name) for f in INSIGHT.fields])
