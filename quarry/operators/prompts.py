"""Prompts and request payloads for labelling and translation."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import rules
from .calls import payload
from .resolve import DIFFICULTY, QUALITY

PROMPT_VERSION = "template-v1"


def taxonomy_prompt() -> str:
    """The system prompt that asks for one vote: the labels with their definitions, their borders, and the reply's shape."""
    labels = [f"- {label} ({major}/{name}): {definition}" for label, major, name, definition in rules.TAXONOMY]
    keys = ["primary_label", "secondary_labels", "taxonomy_fit", "confidence", "rationale"]
    example = dict(zip(keys, ["AD", [], "exact", 0.95, "It asks where the series is abnormal."], strict=True))
    return "\n".join(
        [
            "You name the capability that a question about time series requires. Judge by the operation that leads to the answer, not by topic or wording.",
            "Labels:",
            *labels,
            "Borders: a pattern that is seen (PR) or a rule that is applied to a new case (IR); similarity (CA) or a directed cause (CD);",
            "a general cause (ER) or the event behind one change (AR); a quantity (NR) or a choice among actions by their outcomes (QuantDM);",
            "future values (TSF) or a future event (EP). Filling gaps and plain classification fit no label exactly: closest or out_of_scope.",
            f"Reply with one JSON object with the keys {', '.join(keys)}. primary_label is a label or null; taxonomy_fit is one of {', '.join(rules.FITS)}; confidence lies between 0 and 1.",
            "Example: " + json.dumps(example, separators=(",", ":")),
        ]
    )


def quality_prompt() -> str:
    """The system prompt that asks for a template's quality and difficulty."""
    return "\n".join(
        [
            "You judge a template of questions and answers about time series as training data. Series and numbers are masked; judge what the template asks and how it is answered.",
            f"quality is one of {', '.join(QUALITY)}: is the question clear, can it be answered from the series, does the form of the answer fit?",
            f"difficulty is one of {', '.join(DIFFICULTY)}: how many steps and how much knowledge does an answer take?",
            "Reply with one JSON object with the keys quality, difficulty and reason (one sentence).",
        ]
    )


def quality_payload(model: str, most: int = 256) -> Column:
    """The request (JSON text) for a template: columns question_template, answer_structure, representative_answer_template."""
    user = F.to_json(F.struct("answer_structure", "question_template", "representative_answer_template"))
    return with_user(json.dumps(payload(model, quality_prompt(), "\0", most, json_mode=True), ensure_ascii=False), user)


def taxonomy_payload(model: str, prompt: Column, most: int = 512, **options) -> Column:
    """The request (JSON text) for a vote on a prompt. options: thinking, effort, json_mode."""
    return with_user(json.dumps(payload(model, taxonomy_prompt(), "\0", most, **options), ensure_ascii=False), prompt)


def with_user(request: str, user: Column) -> Column:
    """A request whose user message, the one that is a zero character, is filled in as a JSON string."""
    before, after = request.split(json.dumps("\0"))
    quoted = F.regexp_extract(F.to_json(F.struct(F.coalesce(user, F.lit("")).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    return F.concat(F.lit(before), quoted, F.lit(after))


def translation_payload(model: str, texts: Column, language: str = "Simplified Chinese", most: int = 4096) -> Column:
    """The request for a translation of a map of texts, written as JSON with sorted keys."""
    system = f"Translate each value of the JSON object into {language}. Keep tags, numbers, option letters, units and names. Reply with one JSON object of the same keys and nothing else."
    return with_user(json.dumps(payload(model, system, "\0", most, json_mode=True), ensure_ascii=False), translation_source(texts))


def translation_source(texts: Column) -> Column:
    """The texts that aren't blank as canonical JSON: keys sorted."""
    kept = F.filter(F.map_entries(texts), lambda e: F.trim(F.coalesce(e["value"], F.lit(""))) != "")
    return F.to_json(F.map_from_entries(F.array_sort(kept)))


def translation_key(model: str, texts: Column) -> Column:
    """What a translation is cached by."""
    return F.sha2(F.concat(F.lit(model + "\n"), translation_source(texts)), 256)
