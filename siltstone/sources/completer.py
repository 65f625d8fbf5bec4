"""Language-model steps as functions from prompts to replies; the default stands in offline."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siltstone.functions.text import section, synthesis_parts, unexpired

#: The empty reply of each step, in the shape that its readers expect.
EMPTY = {
    "interpret": {"deck_type": "other", "account": [], "campaign": []},
    "asset_folder": {"account": [], "campaign": []},
    "distill": {"field_changes": [], "notes": [], "ambiguous": []},
    "synthesize": {"sections": {}},
    "classify_folders": {"labels": []},
    "cluster": {"clusters": []},
    "extract_ideas": {"ideas": []},
    "match_idea": {"match_index": 0, "merged_facets": []},
    "derive_pieces": {"pieces": []},
}
ATTEMPTS = 3


class Completer(Protocol):
    def complete(self, step: str, prompt: str) -> str: ...


class OfflineCompleter:
    """Answers each step with its empty reply."""

    def complete(self, step: str, prompt: str) -> str:
        return json.dumps(EMPTY.get(step, {}))


def complete(prompts: DataFrame, completer: Completer | None = None) -> DataFrame:
    """``prompts`` (id, step, prompt) as (id, step, reply, error, attempts); a call is tried up to three times."""
    completer = completer or OfflineCompleter()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for i, step, prompt in zip(part["id"], part.step, part.prompt):
                reply = error = None
                for n in range(1, ATTEMPTS + 1):
                    try:
                        reply, error = completer.complete(step, prompt), None
                        break
                    except Exception as e:  # the error is the row's result
                        error = str(e)[:500]
                out.append((i, step, reply, error, n))
            yield pd.DataFrame(out, columns=["id", "step", "reply", "error", "attempts"])

    return prompts.select("id", "step", "prompt").mapInPandas(run, "id string, step string, reply string, error string, attempts int")


#: The columns that a step's prompt is rendered from, in the order in which they are shown.
INPUTS = {
    "interpret": ("vocabulary", "text"),
    "asset_folder": ("path", "file_names"),
    "distill": ("state", "known_facts", "observations"),
    "synthesize": ("prior", "new"),
    "classify_folders": ("anchors", "tree"),
    "cluster": ("names",),
    "extract_ideas": ("text",),
    "match_idea": ("candidates", "idea"),
    "derive_pieces": ("dossier",),
}


def prompts_of(rows: DataFrame, step: str) -> DataFrame:
    """(id, step, prompt) of rows (id and the columns of ``INPUTS[step]``): each under its name, lists a line an entry, nulls left out."""
    kinds = dict(rows.dtypes)
    shown = lambda c: F.array_join(c, "\n") if kinds[c].startswith("array<string") else F.to_json(c) if kinds[c].startswith(("array", "struct", "map")) else F.col(c).cast("string")
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"## {c}\n"), shown(c))) for c in INPUTS[step]]
    return rows.select(F.col("id").cast("string").alias("id"), F.lit(step).alias("step"), F.concat_ws("\n\n", *parts).alias("prompt"))


#: The shape of a reply, by step.
REPLIES = {
    "interpret": "deck_type string, account array<string>, campaign array<string>",
    "extract_ideas": "ideas array<struct<name string, facets array<string>>>",
    "match_idea": "match_index int, merged_facets array<string>",
    "cluster": "clusters array<struct<canonical string, variants array<string>, confidence double>>",
}


def read_replies(replies: DataFrame, step: str) -> DataFrame:
    """(id, error, and the fields of the step's reply); a reply that is no JSON of that shape gives nulls and the error ``unreadable``."""
    parsed = replies.filter(F.col("step") == step).withColumn("_r", F.from_json("reply", REPLIES[step]))
    fields = [f.strip().split(" ")[0] for f in re.split(r",\s*(?![^<]*>)", REPLIES[step])]
    empty = F.coalesce(*(F.col(f"_r.{f}").cast("string") for f in fields)).isNull()
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(empty, "unreadable")
    return parsed.select("id", error.alias("error"), *(F.col(f"_r.{f}").alias(f) for f in fields))


def merged_documents(variants: DataFrame, as_of: str, completer: Completer | None = None) -> DataFrame:
    """(id, general, sensitive, skipped) for variants (id, position, status, sensitive) of each merged entity.

    The bullets of all variants' context and of what has not expired of their transient sections go into one prompt, in order
    of position. An entity without any is not asked about: ``skipped``, with null documents. General and sensitive parts of the
    reply come back as documents of their own, null if they are empty.
    """
    kept = {}
    for column in ("status", "sensitive"):
        transient = unexpired(section(F.col(column), "Transient"), F.lit(as_of))
        kept |= {f"{column}_context": section(F.col(column), "Context"), f"{column}_transient": transient}
    own = variants.select("id", "position", *(c.alias(n) for n, c in kept.items()))
    in_order = lambda n: F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(n).isNotNull(), F.struct("position", F.col(n).alias("x"))))), lambda s: s["x"]), "\n"), F.lit("")).alias(n)
    prior = own.groupBy("id").agg(*(in_order(n) for n in kept)).withColumn("id", F.col("id").cast("string"))
    none = F.coalesce(*kept).isNull()
    asked = prior.filter(~none).select("id", F.to_json(F.struct(*kept)).alias("prior"), F.lit(None).cast("string").alias("new"))
    parts = complete(prompts_of(asked, "synthesize"), completer).select("id", synthesis_parts(F.col("reply")).alias("p"))
    document = lambda *names: F.nullif(F.concat_ws("\n\n", *(F.when(F.col(f"p.{n}") != "", F.concat(F.lit(f"## {h}\n"), F.col(f"p.{n}"))) for h, n in names)), F.lit(""))
    general = document(("Context", "general_context"), ("Transient", "general_transient"))
    sensitive = document(("Context", "sensitive_context"), ("Transient", "sensitive_transient"))
    told = parts.select("id", general.alias("general"), sensitive.alias("sensitive"), F.lit(False).alias("skipped"))
    missing = F.lit(None).cast("string")
    return told.unionByName(prior.filter(none).select("id", missing.alias("general"), missing.alias("sensitive"), F.lit(True).alias("skipped")))


def gated_ideas(replies: DataFrame) -> DataFrame:
    """Ideas (id, position, name, facets) of interpreted files; a deck of type other has none, blank names and facets drop out."""
    parsed = replies.withColumn("r", F.from_json("reply", "deck_type string, ideas array<struct<name string, facets array<string>>>")).filter("r.deck_type IN ('pitch', 'creative_review')")
    ideas = parsed.select("id", F.posexplode("r.ideas").alias("position", "idea"))
    facets = F.filter(F.transform("idea.facets", lambda f: F.trim(f)), lambda f: f != "")
    return ideas.select("id", "position", F.trim("idea.name").alias("name"), facets.alias("facets")).filter("name <> ''")
