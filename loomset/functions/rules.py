"""Values that results depend on, kept as configuration. Every operator takes them as a parameter."""

from __future__ import annotations

# Labels and keywords, in order, that decide a failure type.
FAILURE_TYPES = {
    "hallucination": ["hallucin"],
    "schema_break": ["schema", "format violation", "json valid"],
    "missing_step": ["missing", "reasoning", "wrong_reasoning", "incomplete"],
    "tool_misuse": ["tool", "retrieval", "function call"],
    "instruction_drift": ["drift", "instruction", "ignored"],
    "overgeneralization": ["general", "broad", "universal"],
    "safety_bypass": ["safety", "bypass", "pii", "leak"],
    "cascading_error": ["cascading", "stale"],
    "clean_pass": ["clean_pass"],
}

# Tasks in order, and keywords of which an answer to a task must hold one.
TASKS = ["diagnose", "repair", "prevent", "detect", "compare"]
TASK_KEYWORDS = {
    "diagnose": ["root cause", "failure", "severity", "cause"],
    "repair": ["step", "fix", "correct", "recover"],
    "prevent": ["guardrail", "check", "prevent", "trigger"],
    "detect": ["positive", "negative", "confidence", "evidence"],
    "compare": ["output a", "output b", "superior", "score"],
}

# Which task a source's name means; the first that it contains.
SOURCE_TASKS = {"diagnose": ["diagnose"], "repair": ["repair"], "prevent": ["prevent"], "detect": ["detect"], "compare": ["compare", "rank"]}

# Limits of lengths, in characters.
MIN_ASSISTANT, MIN_USER, MAX_TOTAL, MIN_TRACE = 50, 10, 32_000, 100
PROMPT_CUT, OUTPUT_CUT, REPAIR_CUT = 2000, 3000, 3000

# Failure taxonomy, and target shares of failure types in percent.
TAXONOMY = {
    "reasoning": ["missing_step", "false_assumption"],
    "knowledge": ["hallucination", "overgeneralization"],
    "instruction": ["drift", "schema_break"],
    "agent": ["tool_misuse"],
}
TARGET_SHARES = {
    "hallucination": (15, 20),
    "schema_break": (15, 20),
    "missing_reasoning": (15, 20),
    "false_assumption": (10, 15),
    "instruction_drift": (10, 15),
    "tool_misuse": (10, 15),
    "overgeneralization": (5, 10),
}

SYSTEM_PROMPT = "You study failed agent runs: name the failure, mend it, and keep it from coming back."

#: Own wording. {fields} are filled in by operators.prompts; a value is never read as a template.
TEMPLATES = {
    "diagnose": "Agent: {source_model}. Field: {vertical}. Kind of failure: {failure_class}. Reported: {errors}\n\nIt was asked:\n{user_prompt}\n\nIt said:\n{model_output}\n\nTask: name the failure mode, its root cause, how severe it is (1 to 5), and what to do.",
    "repair": "Agent: {source_model}. Field: {vertical}. Kind of failure: {failure_class}. Reported: {errors}\n\nIt was asked:\n{user_prompt}\n\nIt said:\n{model_output}\n\nTask: give the steps that recover from this, then the corrected answer.",
    "prevent": "Agent: {source_model}. Field: {vertical}. Kind of failure: {failure_class}. Reported: {errors}\n\nIt was asked:\n{user_prompt}\n\nTask: describe a guardrail against this kind of failure: what triggers it, what it checks, what it then does, how much it covers.",
    "detect": "Agent: {source_model}. Field: {vertical}. Suspected failure: {failure_class}.\n\nIt said:\n{model_output}\n\nTask: decide whether the failure is there (POSITIVE or NEGATIVE), with confidence (0 to 100), evidence, and the risk of a false alarm.",
    "compare": "Agent: {source_model}. Field: {vertical}. Kind of failure: {failure_class}.\n\nOutput A, as it failed:\n{model_output}\n\nOutput B, as it was mended:\n{repair_output}\n\nTask: rank both, say why one is superior, and score each for correctness, completeness, form and reasoning.",
}
