"""Narration by a language model that the caller brings; nothing leaves the process by default."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import graph
from .operators.risks import context
from .sources.directory import from_directory
from .sources.files import files, inside

#: (provider, model, messages) -> text; messages are dicts with role and content.
Model = Callable[[str, str, list[dict[str, str]]], str]

PROMPT = "Explain in plain words what these structural measures say about the system: its weakest points first, then what to do about them."


def provider_of(model: str) -> tuple[str, str]:
    """(provider, model): a local prefix, a family in the name, or the default provider."""
    for prefix in ("ollama/", "local/"):
        if model.startswith(prefix):
            return "local", model.removeprefix(prefix)
    return ("anthropic", model) if re.search("claude|anthropic", model) else ("openai", model)


def explain(vectors: DataFrame, risks: DataFrame, model: str, call: Model, prompt: str = PROMPT, k: int | None = None) -> str:
    """k: show at most so many nodes and risks, and say how many more there are."""
    return call(*provider_of(model), [{"role": "user", "content": f"{prompt}\n\n{context(vectors, risks, k)}"}])


def ask(vectors: DataFrame, risks: DataFrame, question: str, model: str, call: Model, history: list[dict[str, str]] | None = None, k: int | None = None) -> tuple[str, list[dict[str, str]]]:
    """(answer, history with this turn)."""
    turns = [*(history or []), {"role": "user", "content": question}]
    answer = call(*provider_of(model), [{"role": "system", "content": context(vectors, risks, k)}, *turns])
    return answer, [*turns, {"role": "assistant", "content": answer}]


#: What a model may be shown of one file, and of all.
FILE_CHARS, ALL_CHARS = 60_000, 250_000
# Names of files worth showing, in order of rank.
RANKED = (r"(^|/)README[^/]*$", r"(^|/)(docker-)?compose[^/]*\.ya?ml$", r"\.tf$", r"(^|/)package\.json$", r"(^|/)pyproject\.toml$", r"(^|/)requirements[^/]*\.txt$", r"(^|/)go\.mod$", r"(^|/)Dockerfile[^/]*$", r"\.ya?ml$", r"\.(json|toml)$", r"\.md$", r"\.py$")


def gather(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, running) of the files within the budget, by rank and path. Ranks and
    lengths decide; contents are read once and cut."""
    rank = F.lit(None).cast("int")
    for i, pattern in reversed(list(enumerate(RANKED))):
        rank = F.when(F.regexp_like("path", F.lit(pattern)), i).otherwise(rank)
    own = inside(files(spark, path)).select("path", F.substring("content", 1, FILE_CHARS).alias("content"), rank.alias("rank")).where("rank is not null")
    upto = Window.orderBy("rank", "path").rowsBetween(Window.unboundedPreceding, 0)
    # over the files of one source tree; only their lengths and paths are summed
    sizes = own.select("rank", "path", F.length("content").alias("n")).withColumn("running", F.sum("n").over(upto)).where(F.col("running") <= ALL_CHARS)
    return own.join(sizes.select("path", "running"), "path").select("path", "content", "running")


def parse_edges(reply: str) -> list[tuple[str, str]]:
    """Pairs in a model's reply: the outermost JSON object's edges, fences aside."""
    found = re.search(r"\{.*\}", re.sub(r"```\w*", "", reply), re.S)
    try:
        edges = json.loads(found[0]).get("edges", []) if found else []
    except (ValueError, AttributeError):
        return []
    return [(str(e[0]), str(e[1])) for e in edges if isinstance(e, list) and len(e) >= 2]


def find_edges(spark: SparkSession, path: str, model: str | None = None, call: Model | None = None, max_nodes: int = 0) -> tuple[DataFrame, DataFrame, list[str]]:
    """(edges, counts, log): a directory's edges; where it has none and a model is given, the
    model's; pruned to max_nodes where that is above 0."""
    edges, counts = from_directory(spark, path)
    log = [f"{r['source']}: {r['n_edges']} edges" for r in counts.orderBy("source").collect()]
    if not log and model and call:
        shown = "\n\n".join(f"# {r['path']}\n{r['content']}" for r in gather(spark, path).orderBy("running").collect())
        pairs = parse_edges(call(*provider_of(model), [{"role": "user", "content": f'List the dependencies between components as JSON {{"edges": [["from", "to"]]}}.\n\n{shown}'}]))
        edges = spark.createDataFrame(pairs, "src string, dst string").where("src <> dst").distinct()
        counts = edges.agg(F.count("*").alias("n_edges")).select(F.lit("model").alias("source"), "n_edges")
        log.append(f"model: {len(pairs)} edges")
    if max_nodes > 0 and (n := graph.nodes(edges).count()) > max_nodes:
        edges = graph.prune(edges, max_nodes)
        log.append(f"pruned from {n} nodes to {max_nodes}")
    return edges, counts, log
