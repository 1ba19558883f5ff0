"""Render chat messages to text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Text around each message: ``prefix``, then open + role + middle + content + close each.

    A message keeps its turn when its role or content is null; the null part is empty text.
    """

    prefix: str
    open: str
    middle: str
    close: str

    def render(self, messages: Column, add_generation_prompt: bool = False) -> Column:
        turns = F.transform(
            messages,
            lambda m: F.concat(
                F.lit(self.open), F.coalesce(m["role"], F.lit("")), F.lit(self.middle),
                F.coalesce(m["content"], F.lit("")), F.lit(self.close),
            ),
        )
        reply_open = f"{self.open}assistant{self.middle}" if add_generation_prompt else ""
        return F.concat(F.lit(self.prefix), F.array_join(turns, ""), F.lit(reply_open))


# Declared templates; neither is claimed to equal the template of a given model.
CHATML = ChatTemplate("", "<|im_start|>", "\n", "<|im_end|>\n")
HEADERS = ChatTemplate(
    "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>\n\n", "<|eot_id|>"
)

# Texts of the inference prompt.
INFERENCE_SYSTEM = (
    "You are a helpful assistant that converts natural language questions into SQL queries."
)


def inference_user_text(question: Column, context: Column) -> Column:
    """User text of a request; a schema given as null shows as ``None``."""
    schema = F.coalesce(context, F.lit("None"))
    return F.concat(
        F.lit("### Context:\n"), schema, F.lit("\n\n### Question:\n"), question, F.lit("\n\n### SQL:")
    )


def inference_prompt(
    question: Column, context: Column, template: ChatTemplate | None = None
) -> Column:
    """Prompt of one request; without a template the two texts are joined by a blank line."""
    user = inference_user_text(question, context)
    if template is None:
        return F.concat(F.lit(INFERENCE_SYSTEM + "\n\n"), user)
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(INFERENCE_SYSTEM).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )
    return template.render(messages, add_generation_prompt=True)


def short_prompt(question: Column, context: Column) -> Column:
    return F.concat(
        F.lit("Schema: "), context, F.lit("\nQuestion: "), question, F.lit("\nSQL:")
    )
