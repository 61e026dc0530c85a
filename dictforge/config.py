"""Parameters of the pipeline stages."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default chat formats per model family.
INST_FORMAT = "<s>[INST] {user_prompt} [/INST] {target} </s>"
LLAMA3_FORMAT = (
    "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\n{user_prompt}<|eot_id|>"
    "<|start_header_id|>assistant<|end_header_id|>\n\n{target}<|eot_id|>"
)
CHATML_FORMAT = "<|im_start|>user\n{user_prompt}<|im_end|>\n<|im_start|>assistant\n{target}<|im_end|>"
TURN_FORMAT = (
    "<bos><start_of_turn>user\n{user_prompt}<end_of_turn>\n<start_of_turn>model\n{target}<end_of_turn>"
)

DEFAULT_TEMPLATES = {
    "meta-llama/Llama-2-7b-hf": INST_FORMAT,
    "meta-llama/Meta-Llama-3.1-8B": LLAMA3_FORMAT,
    "Qwen/Qwen2.5-7B": CHATML_FORMAT,
    "sarvamai/sarvam-1": TURN_FORMAT,
}

# Texts that mark a record as unusable, and the default system text.
BLOCKED_TEXTS = ("is defined as: .", "<null>", "undefined", "n/a", "अभिसम्भृत")
SYSTEM_PROMPT = "You are an expert bilingual lexicographer for Indic languages."

# Patterns of the raw dictionary markup, in Java syntax with Unicode classes.
REFERENCE_REGEX = r"""<a(?U)[\s\x1c-\x1f]+[^>]*href=["']/dictionary/([^/]+)/text\?ref=([^"']+)["'][^>]*>"""
SUFFIX_REGEX = r"०([\p{L}\p{Nl}\p{No}]+)"
EXAMPLE_REGEX = r"(?<![\p{L}\p{N}_])Ex\.(?U)[\s\x1c-\x1f]+"
QUOTE_REGEX = r"'([^']+)'(?U)[\s\x1c-\x1f]*-[\s\x1c-\x1f]*([^.]+)\."


@dataclass(frozen=True)
class Config:
    words_per_chunk: int = 5000
    exclude_keywords: tuple[str, ...] = ("unknown", "blank")
    split_regex: str = r"(?U)\s+and\s+|,|/"
    seqno_regex: str = r"\p{Nd}+"
    reference_regex: str = REFERENCE_REGEX
    unmerged_source: str = "wordnet.indo"
    max_chars_per_split: int = 1200
    meanings_per_record: int = 4
    keep_all_citations: bool = False
    enable_suffix_substitution: bool = False
    suffix_regex: str = SUFFIX_REGEX
    usage_ex_regex: str = EXAMPLE_REGEX
    usage_quote_regex: str = QUOTE_REGEX
    max_citations: int = 10
    max_record_length: int = 15000
    min_target_chars: int = 5
    max_target_chars: int = 10000
    blocked_texts: tuple[str, ...] = BLOCKED_TEXTS
    relation_tasks: bool = False
    model_id: str = "meta-llama/Llama-2-7b-hf"
    templates: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_TEMPLATES))
    fallback_model_id: str = "meta-llama/Meta-Llama-3.1-8B"
    batch_size: int = 1
    gradient_accumulation_steps: int = 64
    epochs: int = 5
    warmup_ratio: float = 0.03
    valid_records: int = 100
    max_nan_threshold: int = 3
    max_rollbacks: int = 100
    keep_checkpoints: int = 5
    # Items a nested row may hold before it continues in another row.
    items_per_row: int = 10_000
    # Characters (as JSON) of the items of one nested row, in the mean of a word that needs several rows.
    chars_per_row: int = 64_000_000

    @property
    def records_per_iteration(self) -> int:
        return self.batch_size * self.gradient_accumulation_steps

    def template(self, model_id: str | None = None) -> str:
        """Format of a model, with the fallback chain: own, fallback model, plain instruction form."""
        wanted = self.model_id if model_id is None else model_id
        return self.templates.get(wanted, self.templates.get(self.fallback_model_id, INST_FORMAT))
