"""Sources of edges: files by format, directories, graph documents, text, live services."""

from .directory import from_directory
from .files import (
    files, from_autogen, from_aws_cdk, from_cloudformation, from_crewai, from_docker_compose, from_github_actions, from_kubernetes,
    from_langgraph, from_otel_traces, from_package_json, from_package_json_workspaces, from_pulumi, from_python_imports, from_terraform,
)
from .text import graph_documents, text_edges

__all__ = [
    "files", "from_autogen", "from_aws_cdk", "from_cloudformation", "from_crewai", "from_directory", "from_docker_compose", "from_github_actions",
    "from_kubernetes", "from_langgraph", "from_otel_traces", "from_package_json", "from_package_json_workspaces", "from_pulumi",
    "from_python_imports", "from_terraform", "graph_documents", "text_edges",
]
