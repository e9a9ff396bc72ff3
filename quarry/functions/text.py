"""String functions as Column expressions.

Java's classes are ASCII unless a pattern begins with (?U); with it, and with the separators U+001C to U+001F mapped to
spaces first, they agree with the classes of the data's definition. Patterns that repeat over numbers are possessive,
so that texts of any length match without recursion.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that template ids depend on.
NUMBER = r"(?>[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?)"
SERIES_TOKEN = r"(?Ui)<ts>\s*(?:<ts\s*/>)?|<ts\s*/>"
BRACKETED = rf"(?U)\[(?:\s*+{NUMBER}\s*+,){{3,}}+\s*+{NUMBER}\s*+\]"
UNBRACKETED = rf"(?U)(?=[-+.\d])(?<![\w.]){NUMBER}(?![\w.])(?:\s*+[,;|]\s*+{NUMBER}(?![\w.])){{3,}}+"
NESTED = r"(?Ui)\[(?:\s*+<ts>\s*+,?+)++\]"
SCALAR = rf"(?U)(?=[-+.\d])(?<![\w.]){NUMBER}(?![\w.])"
#: What each match of BRACKETED, UNBRACKETED or NESTED holds.
FOLDABLE = rf"(?U)[,;|]\s*+{NUMBER}(?:\s*+[,;|]\s*+{NUMBER}){{2}}|\[\s*+<"
#: White space but for single spaces.
RUN = r"(?U)[\s&&[^ ]]\s*+| \s++"
CHOICE = r"(?Ui)^(?:<answer>\s*)?\(?[A-D]\)?(?:\s*</answer>)?$"
TAGGED_CHOICE = r"(?Ui)<answer>\s*\(?[A-D]\)?\s*</answer>"
URL = r"(?U)https?://\S+"
TEMPLATE_NUMBER = r"(?U)(?<![a-z])[-+]?\d+(?:\.\d+)?(?:e[-+]?\d+)?"
ANY_CASE_NUMBER = r"(?Uiu)(?<![a-z])[-+]?\d+(?:\.\d+)?(?:e[-+]?\d+)?"
SERIES_SPAN = r"(?Uis)<ts>.*?<ts\s*/>"
ANSWER = r"(?Uis)<answer>(.*?)</answer>"
ANSWER_LABEL = r"(?Ui)^\s*(?:\(?[A-Za-z]\)?|true|false)\s*$"
NUMBERED_ITEM = r"(?U)(?:^|\n)\s*\d+[.)]\s+"
LEAKS = (r"(?Uis)must\s+(?:end|conclude).*?answer\s*:", r"(?Ui)final sentence must conclude with", r"(?Ui)correct answer (?:is|must be)")
VISUAL = r"(?Ui)\b(?:graph|plot|chart|x-axis|y-axis|visual(?:ization)?)\b"
PLACEHOLDER = "<ts><ts/>"
#: Patterns of a letter, in order, each with the signs of which a match holds one.
CHOICE_PATTERNS = (
    (r"(?Ui)<answer>\s*([A-G])\s*</answer>", ("<",)),
    (r"(?Ui)[\"']?answer[\"']?\s*[:=]\s*[\"']?([A-G])", (":", "=")),
    (r"(?Ui)(?:^|\n)\s*(?:final\s+answer\s*[:：]?\s*)?([A-G])[.)]", (".", ")")),
    (r"(?Ui)^\s*([A-G])\s*(?:\r?\n|$)", ()),
)
FENCE = r"(?Ui)^```(?:json|python)?\s*|\s*```$"


def bind(value: Column, body) -> Column:
    """body(value), where value is computed once a row however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spaced(text: Column) -> Column:
    held = lambda x: reduce(Column.__or__, (F.contains(x, F.lit(c)) for c in "\x1c\x1d\x1e\x1f"))
    return bind(text, lambda x: F.when(held(x), F.translate(x, "\x1c\x1d\x1e\x1f", "    ")).otherwise(x))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_spaced(text), r"(?U)^\s+|\s+$", "")


def compact(text: Column) -> Column:
    """Runs of white space as one space, ends trimmed."""
    return _compact(_spaced(text))


def _compact(spaced: Column) -> Column:
    return F.trim(F.regexp_replace(spaced, RUN, " "))


def fold_series(text: Column) -> Column:
    """Series tokens and arrays of four numbers or more as ``<ts>``, nested ones too, in three passes.

    Passes run only on texts that hold what one of their patterns can't do without; most prose holds none."""
    marked = bind(_spaced(text), lambda x: F.when(F.contains(x, F.lit("<")), F.regexp_replace(x, SERIES_TOKEN, "<ts>")).otherwise(x))
    return _compact(bind(marked, lambda x: F.when(x.rlike(FOLDABLE), _folded(x)).otherwise(x)))


def _folded(text: Column) -> Column:
    for _ in range(3):
        for pattern in (BRACKETED, UNBRACKETED, NESTED):
            text = F.regexp_replace(text, pattern, "<ts>")
    return text


def mask_scalars(text: Column) -> Column:
    return F.regexp_replace(text, SCALAR, "<num>")


def structure(answer: Column) -> Column:
    """The form of a training answer."""
    return bind(fold_series(answer), lambda said: _structure(said, answer))


def _structure(said: Column, answer: Column) -> Column:
    """said: the folded answer."""
    low = F.lower(said)
    has = lambda tag: F.contains(low, F.lit(tag))
    return (
        F.when(has("<ts>"), F.when(has("<answer>"), "tagged_time_series").otherwise("time_series"))
        .when(said.rlike(CHOICE), "choice_label")
        .when(said.rlike(TAGGED_CHOICE), F.when(has("<think>"), "reasoning_with_label").otherwise("choice_label"))
        .when(has("<think>") & has("<answer>"), "reasoning_with_answer")
        .when(has("<answer>"), "tagged_answer")
        .when(said.rlike(rf"(?U)^{NUMBER}$"), "scalar")
        .when(F.contains(answer, F.lit("\n")), "multiline_text")
        .otherwise("text")
    )


def view_structure(answer: Column) -> Column:
    """The form of an answer as the record view tells it: no series folding, any letter as a label."""
    said = strip(F.regexp_replace(_spaced(answer), SERIES_SPAN, "<ts>"))
    low = F.lower(said)
    inner = F.regexp_extract_all(said, F.lit(ANSWER), 1)
    candidate = F.when(F.size(inner) > 0, strip(F.element_at(inner, -1))).otherwise(said)
    has = lambda tag: F.contains(low, F.lit(tag))
    return (
        F.when(has("<ts>"), F.when(has("<answer>"), "tagged_time_series").otherwise("time_series"))
        .when(candidate.rlike(ANSWER_LABEL), "choice_label")
        .when(has("<think>") & has("<answer>"), "reasoning_with_answer")
        .when(has("<answer>"), "tagged_answer")
        .when(F.contains(answer, F.lit("\n")), "multiline_text")
        .otherwise("text")
    )


def question_answer(names: list[str]) -> tuple[Column, Column]:
    """Question and answer from a row's fields; a context goes before the question if there is no input field."""

    def first(*fields: str) -> Column:
        found = [F.when(F.col(f) != "", F.col(f)) for f in fields if f in names]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    question, context = first("input", "question", "query"), first("context", "context_text")
    has_input = F.coalesce(F.col("input") != "", F.lit(False)) if "input" in names else F.lit(False)
    joined = F.concat(F.lit("Context:\n"), strip(context), F.lit("\n\nQuestion:\n"), strip(question))
    return F.when((strip(F.coalesce(context, F.lit(""))) != "") & ~has_input, joined).otherwise(question), first("output", "response", "answer")


def combined_text(text: Column) -> tuple[Column, Column]:
    """Question and answer from one field, by tags or by headings."""
    tagged = r"(?Uis)<QUE>\s*(.*?)\s*<ANS>\s*(.*?)\s*(?:</END>|\z)"
    headed = r"(?Uis)(?:\A|\n)\s*Question\s*:\s*(.*?)\s*(?:\n\s*)Answer\s*:\s*(.*)\z"
    pick = lambda k: F.when(text.rlike(tagged), F.regexp_extract(text, tagged, k)).when(text.rlike(headed), F.regexp_extract(text, headed, k))
    return strip(pick(1)), strip(pick(2))


def _json(text: Column) -> Column:
    """A JSON string, as compact canonical JSON writes it."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)


def template(question: Column, answer: Column) -> Column:
    """question_template, answer_structure, representative_answer_template, template_id, input_hash."""
    folded = F.struct(mask_scalars(fold_series(question)).alias("asked"), fold_series(answer).alias("said"))
    formed = bind(folded, lambda x: F.struct(x["asked"].alias("asked"), x["said"].alias("said"), _structure(x["said"], answer).alias("form")))
    return bind(formed, lambda x: _template(x["asked"], x["said"], x["form"]))


def _template(asked: Column, said: Column, form: Column) -> Column:
    shown = F.when(said.rlike(CHOICE), "<label>").otherwise(mask_scalars(F.regexp_replace(said, TAGGED_CHOICE, "<answer><label></answer>")))
    key = F.concat(F.lit('{"answer_structure":'), _json(form), F.lit(',"question_template":'), _json(asked), F.lit("}"))
    digest = F.sha2(key, 256)
    return F.struct(asked.alias("question_template"), form.alias("answer_structure"), shown.alias("representative_answer_template"), F.substring(digest, 1, 24).alias("template_id"), digest.alias("input_hash"))


def cluster_template(prompt: Column) -> Column:
    """Lower-cased prompt with placeholders, addresses and numbers masked and white space single."""
    out = F.replace(F.lower(_spaced(prompt)), F.lit(PLACEHOLDER), F.lit(" <ts> "))
    return compact(F.regexp_replace(F.regexp_replace(out, URL, "<url>"), TEMPLATE_NUMBER, "<num>"))


def view_template(prompt: Column) -> Column:
    """As cluster_template, but written-out series spans are folded too."""
    out = F.replace(F.lower(_spaced(prompt)), F.lit(PLACEHOLDER), F.lit(" <ts> "))
    out = F.regexp_replace(F.regexp_replace(out, SERIES_SPAN, " <ts> "), URL, "<url>")
    return compact(F.regexp_replace(out, ANY_CASE_NUMBER, "<num>"))


def view_template_id(prompt: Column, output: Column) -> Column:
    """The record view's own template id, which keeps case and white space."""
    asked = F.regexp_replace(F.regexp_replace(prompt, SERIES_SPAN, "<ts>"), ANY_CASE_NUMBER, "<num>")
    key = F.concat(F.lit('{"answer_structure":'), _json(view_structure(output)), F.lit(',"question_template":'), _json(asked), F.lit("}"))
    return F.substring(F.sha2(key, 256), 1, 24)


def cluster_id(source: Column, template: Column) -> Column:
    return F.substring(F.sha2(F.concat(source, F.lit("\n"), template), 256), 1, 24)


def sample_id(source: Column, index: Column, digest: Column) -> Column:
    return F.concat(source, F.lit(":"), index.cast("string"), F.lit(":"), F.substring(digest, 1, 16))


def answer_class(output: Column) -> Column:
    """The last tagged answer, or the whole output, if short and of one line; else the output's form. 160 characters."""
    inner = F.regexp_extract_all(_spaced(output), F.lit(ANSWER), 1)
    said = strip(F.when(F.size(inner) > 0, F.element_at(inner, -1)).otherwise(output))
    return F.substring(F.when((F.length(said) <= 80) & ~F.contains(said, F.lit("\n")), said).otherwise(view_structure(output)), 1, 160)


def choice(text: Column) -> Column:
    """The letter A to G that an answer names, or null: a JSON or literal dictionary's answer, else four patterns.

    The answer is stripped once, each pattern runs once, and only where a sign is there that it can't do without."""
    fenced = lambda x: F.when(F.contains(x, F.lit("```")), F.regexp_replace(x, FENCE, "")).otherwise(x)
    return bind(strip(text), lambda x: bind(fenced(x), _choice))


def _first(said: Column, pattern: str, group: int) -> Column:
    """A group of a pattern's first match, or null."""
    return F.get(F.regexp_extract_all(said, F.lit(pattern), F.lit(group)), F.lit(0))


def _choice(said: Column) -> Column:
    has = lambda *signs: reduce(Column.__or__, (F.contains(said, F.lit(x)) for x in signs))
    listed = F.coalesce(bind(F.get_json_object(said, "$.answer"), lambda v: F.when(v != "", v)), _first(said, r"(?U)['\"]answer['\"]\s*:\s*['\"]([^'\"]*)['\"]", 1))
    dictionary = F.when(F.startswith(said, F.lit("{")) & said.rlike(r"(?Us)^\{.*\}$"), _first(listed, r"(?i)[A-G]", 0))
    found = [F.when(has(*signs), _first(said, p, 1)) if signs else _first(said, p, 1) for p, signs in CHOICE_PATTERNS]
    return F.when(said != "", F.upper(F.coalesce(dictionary, *found)))


def question_count(prompt: Column) -> Column:
    """Numbered items at line starts, one at least."""
    return F.greatest(F.lit(1), F.regexp_count(_spaced(prompt), F.lit(NUMBERED_ITEM)))


def issues(prompt: Column, output: Column, verifier: Column | None = None) -> Column:
    """Flags in their fixed order; verifier: the reasoning status of the audit, if any."""
    leak = prompt.rlike(LEAKS[0]) | prompt.rlike(LEAKS[1]) | prompt.rlike(LEAKS[2])
    visual = output.rlike(VISUAL) & ~prompt.rlike(VISUAL)
    flags = [F.when(leak, F.lit("answer_leakage")), F.when(visual, F.lit("visual_grounding_mismatch"))]
    if verifier is not None:
        flags.append(F.when(F.contains(F.coalesce(verifier, F.lit("")), F.lit("unverified")), F.lit("unverified_reasoning")))
    return F.array_compact(F.array(*flags))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9_.-]+", "_"), r"^[._]+|[._]+$", "")


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """100 * part / whole, half to even, 0 for an empty whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.bround(F.lit(100.0) * part / whole, digits))


def nonnegative(text: Column) -> Column:
    """A decimal integer as text, or null."""
    said = strip(text)
    return F.when(said.rlike(r"^[0-9]+$"), said.try_cast("long"))


def read_object(text: Column, shape: str) -> Column:
    """The struct that stands between the outermost braces of a reply; null if anything else stands there too. In
    brackets the JSON reader doesn't overlook what follows the first object."""
    found = F.from_json(F.concat(F.lit("["), named_object(text), F.lit("]")), f"array<{shape}>")
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def read_map(text: Column) -> Column:
    """The object between a reply's outermost braces as a map of strings, under the same rule."""
    found = F.from_json(F.concat(F.lit("["), named_object(text), F.lit("]")), "array<map<string,string>>")
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def named_object(text: Column) -> Column:
    """What stands between the outermost braces of a model's reply, without its fence."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
