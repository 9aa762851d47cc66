"""A directory's edges: every file is classified by a column expression, parsed once by
the parser of its format, and each format's facts become edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import EDGES_OF, facts, files, inside, is_template

# Places and names by which formats are known.
COMPOSE = ("docker-compose.yml", "docker-compose.yaml", "compose.yml", "compose.yaml")
TRACES = ("traces.json", "otel.json", "otlp.json", "jaeger.json", "zipkin.json")
FRAMEWORKS = {
    "langgraph": ("langgraph",), "crewai": ("crewai",), "autogen": ("autogen", "autogen_agentchat", "autogen_core", "autogen_ext", "ag2"),
    "aws-cdk": ("aws_cdk", "aws_cdk_lib"), "pulumi": ("pulumi",),
}


def formats(path: Column, content: Column) -> Column:
    """An array of the formats that a file is read as."""
    at = lambda pattern: F.regexp_like(path, F.lit(pattern))
    py, head = at(r"\.py$"), F.substring(content, 1, 4096)
    tests = {
        "docker-compose": path.isin(*COMPOSE),
        "kubernetes": at(r"^(k8s|kubernetes|manifests|deploy|deployments)/.*\.ya?ml$"),
        "github-actions": at(r"^\.github/workflows/[^/]+\.ya?ml$"),
        "terraform": at(r"\.tf$"),
        "python-imports": py & ~at(r"(^|/)\.[^/]"),
        "package-json": at(r"(^|/)package\.json$"),
        "otel-traces": path.isin(*TRACES) | at(r"^traces/[^/]+\.json$"),
        "cloudformation": at(r"^((cloudformation|templates|cfn)/)?[^/]+\.(yaml|yml|json|template)$") & is_template(content),
    }
    tests |= {name: py & F.regexp_like(head, F.lit(r"(import|from) (" + "|".join(words) + ")")) for name, words in FRAMEWORKS.items()}
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in tests.items()]), lambda x: x.isNotNull())


def _all_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a tree, and its workflows: Spark's listing passes hidden folders over."""
    root, hidden = path.rstrip("/"), ".github/workflows"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{hidden}")
    found = files(spark, path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        found = found.unionByName(files(spark, f"{root}/{hidden}").withColumn("path", F.concat(F.lit(f"{hidden}/"), "path")))
    return found


def from_directory(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(edges, counts): distinct edges, and (source, n_edges) before duplicates across formats go.
    Files that can't be parsed have no facts."""
    table = inside(_all_files(spark, path))
    table = table.select("path", "content", F.explode(formats(F.col("path"), F.col("content"))).alias("fmt"))
    f = facts(table, F.col("fmt"), strict=False).cache()  # small: a fact is a few names
    # workspaces count only where the root has a package of its own
    rooted = not f.where("fmt = 'package-json' and path = 'package.json'").isEmpty()
    out = None
    for name, edges_of in EDGES_OF.items():
        if name == "package-json" and not rooted:
            continue
        own = edges_of(f.where(F.col("fmt") == name)).select("src", "dst", F.lit(name).alias("source"))
        out = own if out is None else out.unionByName(own)
    return out.select("src", "dst").distinct(), out.groupBy("source").agg(F.count("*").alias("n_edges"))
