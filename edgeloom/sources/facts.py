"""Facts of one file: what a parser finds by looking at that file alone.

A parser takes a file's path and content and yields (kind, name, ref, props): `name`
and `ref` are the two ends or one of them, props a string map. Facts are rows; what
needs several files or a look-up (selectors, local packages, known resources, longest
module prefix, topologies) is a join of facts in `files`. Parsers run on executors.
"""

from __future__ import annotations

import ast
import json
import os
import re
from collections.abc import Callable, Iterator

Fact = tuple[str, str | None, str | None, dict[str, str]]
Parser = Callable[[str, str], Iterator[Fact]]


class FormatError(ValueError):
    """Content that isn't of the format."""


def _yaml_all(content: str) -> list:
    import yaml

    return [d for d in yaml.safe_load_all(content) if d is not None]


def _dict(x) -> dict:
    return x if isinstance(x, dict) else {}


def _list(x) -> list:
    return x if isinstance(x, list) else []


def _names(x) -> list[str]:
    """A string, a list or a map's keys as names."""
    if isinstance(x, str):
        return [x]
    return [str(v) for v in x] if isinstance(x, list | dict) else []


def _strings(x) -> dict[str, str]:
    return {str(k): str(v) for k, v in _dict(x).items()}


def compose(path: str, content: str) -> Iterator[Fact]:
    doc = _dict((_yaml_all(content) or [None])[0])
    if "services" not in doc:
        raise FormatError(f"{path}: no services")
    for name, body in _dict(doc["services"]).items():
        body = _dict(body)
        for dep in _names(body.get("depends_on")):
            yield "edge", str(name), dep, {}
        for link in _names(body.get("links")):
            target = link.partition(":")[0]
            if target != name:
                yield "edge", str(name), target, {}


def kubernetes(path: str, content: str) -> Iterator[Fact]:
    for doc in _yaml_all(content):
        doc = _dict(doc)
        kind, name, spec = doc.get("kind"), str(_dict(doc.get("metadata")).get("name", "")), _dict(doc.get("spec"))
        if kind == "Service":
            yield "service", name, None, _strings(spec.get("selector"))
        elif kind in ("Deployment", "StatefulSet", "DaemonSet"):
            template = _dict(spec.get("template"))
            yield "workload", name, None, _strings(_dict(template.get("metadata")).get("labels"))
            for container in _list(_dict(template.get("spec")).get("containers")):
                for env in _list(_dict(container).get("env")):
                    if isinstance(value := _dict(env).get("value"), str):
                        yield "env", name, value, {}
        elif kind == "Ingress":
            name = name or "ingress"
            for rule in _list(spec.get("rules")):
                for p in _list(_dict(_dict(rule).get("http")).get("paths")):
                    backend = _dict(_dict(p).get("backend"))
                    if target := _dict(backend.get("service")).get("name") or backend.get("serviceName"):
                        yield "edge", name, str(target), {}


def github_actions(path: str, content: str) -> Iterator[Fact]:
    doc = _dict((_yaml_all(content) or [None])[0])
    flow = str(doc.get("name") or os.path.splitext(os.path.basename(path))[0])
    for job, body in _dict(doc.get("jobs")).items():
        needs = _names(_dict(body).get("needs"))
        for dep in needs:
            yield "edge", f"{flow}/{dep}", f"{flow}/{job}", {}
        if not needs:
            yield "edge", flow, f"{flow}/{job}", {}


# Fixed value: a resource header.
_resource = re.compile(r'resource\s+"([^"]+)"\s+"([^"]+)"\s*\{')


def terraform(path: str, content: str) -> Iterator[Fact]:
    heads = list(_resource.finditer(content))
    for head, after in zip(heads, [*heads[1:], None]):
        own = f"{head[1]}.{head[2]}"
        yield "resource", own, head[2], {}
        for ref in re.findall(r"(\w+\.\w+)\.", content[head.end() : after.start() if after else None]):
            if ref != own:
                yield "ref", own, ref, {}


# Fixed value: an import statement at the start of a line.
_import = re.compile(r"^\s*(?:from\s+([\w.]+)\s+import|import\s+([\w.]+))", re.M)


def python_imports(path: str, content: str) -> Iterator[Fact]:
    """path is relative to the scanned root."""
    stem = path.removesuffix(".py").removesuffix("/__init__")
    module = stem.replace("/", ".")
    parts = module.split(".")
    if not path.endswith(".py") or any(p == "" or p == "__pycache__" for p in parts):
        return
    for i in range(1, len(parts) + 1):
        yield "module", ".".join(parts[:i]), None, {}
    for a, b in _import.findall(content):
        name = a or b
        # relative imports: one package up for each dot after the first
        dots = len(name) - len(name.lstrip("."))
        if dots:
            package = parts if path.endswith("__init__.py") else parts[:-1]
            base = package[: len(package) - dots + 1]
            name = ".".join([*base, name.lstrip(".")]).strip(".")
        if name:
            yield "import", module, name, {}


def package_json(path: str, content: str) -> Iterator[Fact]:
    doc = json.loads(content)
    if not isinstance(doc, dict):
        raise FormatError(f"{path}: not an object")
    name = str(doc.get("name") or "project")
    yield "package", name, None, {}
    for part in ("dependencies", "devDependencies", "peerDependencies"):
        for dep in _dict(doc.get(part)):
            yield "dep", name, str(dep), {}


# Short tags of intrinsic functions.
_TAGS = "Ref GetAtt Sub Join Select Split ImportValue FindInMap GetAZs Base64 Cidr If Equals And Or Not Condition".split()


def _cfn_load(path: str, content: str):
    import yaml

    if path.endswith(".json") or content.lstrip().startswith("{"):
        return json.loads(content)

    class Loader(yaml.SafeLoader):
        pass

    def tagged(loader, node):
        name = node.tag[1:]
        key = name if name in ("Ref", "Condition") else f"Fn::{name}"
        if isinstance(node, yaml.ScalarNode):
            return {key: loader.construct_scalar(node)}
        if isinstance(node, yaml.SequenceNode):
            return {key: loader.construct_sequence(node, deep=True)}
        return {key: loader.construct_mapping(node, deep=True)}

    for t in _TAGS:
        Loader.add_constructor(f"!{t}", tagged)
    return yaml.load(content, Loader)


def _cfn_refs(x) -> Iterator[str]:
    todo = [x]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            todo += x
        elif isinstance(x, dict):
            for key, value in x.items():
                if key == "Ref" and isinstance(value, str):
                    yield value
                elif key == "Fn::GetAtt":
                    head = value[0] if isinstance(value, list) and value else value
                    if isinstance(head, str):
                        yield head.split(".")[0]
                elif key == "Fn::Sub":
                    head = value[0] if isinstance(value, list) and value else value
                    if isinstance(head, str):
                        yield from re.findall(r"\$\{(\w+)(?:\.[\w.]+)?\}", head)
                    todo.append(value[1:] if isinstance(value, list) else [])
                else:
                    todo.append(value)


def cloudformation(path: str, content: str) -> Iterator[Fact]:
    doc = _dict(_cfn_load(path, content))
    if not isinstance(doc.get("Resources"), dict):
        raise FormatError(f"{path}: no Resources")
    for name, body in doc["Resources"].items():
        body = _dict(body)
        yield "resource", str(name), None, {}
        for dep in [*_names(body.get("DependsOn")), *_cfn_refs(body.get("Properties"))]:
            yield "ref", str(name), dep, {}


# --- Python sources --------------------------------------------------------


def _label(node) -> str | None:
    """A string constant, name or dotted attribute as text."""
    if isinstance(node, ast.Constant):
        return node.value if isinstance(node.value, str) else None
    if isinstance(node, ast.Name):
        return node.id
    if isinstance(node, ast.Attribute):
        base = _label(node.value)
        return f"{base}.{node.attr}" if base else node.attr
    return None


def _callee(call: ast.Call) -> str | None:
    return call.func.id if isinstance(call.func, ast.Name) else call.func.attr if isinstance(call.func, ast.Attribute) else None


def _kw(call: ast.Call) -> dict[str, ast.expr]:
    return {k.arg: k.value for k in call.keywords if k.arg}


def _items(node) -> list[str]:
    return [n for x in node.elts if (n := _label(x))] if isinstance(node, ast.List | ast.Tuple) else []


def _assigned(tree: ast.AST) -> Iterator[tuple[str, ast.Call]]:
    """var = call(...), in the order of the source."""
    found = [n for n in ast.walk(tree) if isinstance(n, ast.Assign) and len(n.targets) == 1 and isinstance(n.targets[0], ast.Name) and isinstance(n.value, ast.Call)]
    for n in sorted(found, key=lambda n: (n.lineno, n.col_offset)):
        yield n.targets[0].id, n.value


def _calls(tree: ast.AST) -> list[ast.Call]:
    return sorted((n for n in ast.walk(tree) if isinstance(n, ast.Call)), key=lambda n: (n.lineno, n.col_offset))


def _constructs(content: str, is_resource: Callable[[ast.Call], bool]) -> Iterator[Fact]:
    own = {var: call for var, call in _assigned(ast.parse(content)) if is_resource(call)}
    for var, call in own.items():
        for value in _kw(call).values():
            for x in value.elts if isinstance(value, ast.List | ast.Tuple) else [value]:
                while isinstance(x, ast.Attribute):
                    x = x.value
                if isinstance(x, ast.Name) and x.id in own and x.id != var:
                    yield "edge", var, x.id, {}


def _is_text(args: list, i: int) -> bool:
    return len(args) > i and isinstance(args[i], ast.Constant) and isinstance(args[i].value, str)


def aws_cdk(path: str, content: str) -> Iterator[Fact]:
    return _constructs(content, lambda c: _is_text(c.args, 1))


def pulumi(path: str, content: str) -> Iterator[Fact]:
    return _constructs(content, lambda c: _is_text(c.args, 0) and isinstance(c.func, ast.Attribute))


def langgraph(path: str, content: str) -> Iterator[Fact]:
    for call in _calls(ast.parse(content)):
        if not isinstance(call.func, ast.Attribute):
            continue
        name, args, kw = call.func.attr, call.args, _kw(call)
        if name == "add_edge" and len(args) == 2:
            starts = _items(args[0]) or [_label(args[0])]
            for a in starts:
                if a and (b := _label(args[1])):
                    yield "edge", a, b, {}
        elif name == "add_conditional_edges" and args and (a := _label(args[0])):
            routes = args[2] if len(args) > 2 else kw.get("path_map") or kw.get("conditional_edge_mapping")
            if isinstance(routes, ast.Dict):
                for v in routes.values:
                    if b := _label(v):
                        yield "edge", a, b, {}
        elif name == "set_entry_point" and args and (b := _label(args[0])):
            yield "edge", "START", b, {}
        elif name == "set_finish_point" and args and (a := _label(args[0])):
            yield "edge", a, "END", {}


def crewai(path: str, content: str) -> Iterator[Fact]:
    tree = ast.parse(content)
    for var, call in _assigned(tree):
        kw = _kw(call)
        if _callee(call) == "Task":
            if a := _label(kw.get("agent")):
                yield "edge", a, var, {}
            for c in _items(kw.get("context")):
                yield "edge", c, var, {}
    for call in _calls(tree):
        kw = _kw(call)
        if _callee(call) == "Crew" and (m := _label(kw.get("manager_agent"))):
            for a in _items(kw.get("agents")):
                yield "edge", m, a, {}


# Group chats by the topology that they make.
_CHATS = {"GroupChat": "legacy", "RoundRobinGroupChat": "ring", "SelectorGroupChat": "complete", "MagenticOneGroupChat": "complete", "Swarm": "complete"}


def autogen(path: str, content: str) -> Iterator[Fact]:
    tree = ast.parse(content)
    for var, call in _assigned(tree):
        kw = _kw(call)
        if kind := _CHATS.get(_callee(call)):
            node = call.args[0] if call.args and isinstance(call.args[0], ast.List | ast.Tuple) else kw.get("agents") or kw.get("participants")
            for pos, a in enumerate(_items(node)):
                yield "member", var, a, {"kind": kind, "pos": str(pos)}
        elif _callee(call) == "GroupChatManager" and (chat := _label(kw.get("groupchat") or kw.get("group_chat"))):
            yield "manager", chat, var, {}
    for call in _calls(tree):
        if isinstance(call.func, ast.Attribute) and call.func.attr == "initiate_chat" and call.args:
            a, b = _label(call.func.value), _label(call.args[0])
            if a and b:
                yield "edge", a, b, {}


# --- traces ----------------------------------------------------------------


def traces(path: str, content: str) -> Iterator[Fact]:
    """Spans: name is the id, ref the parent, props service, trace and format."""
    doc = json.loads(content)
    if isinstance(doc, dict) and "resourceSpans" in doc:
        for resource in _list(doc["resourceSpans"]):
            attributes = _list(_dict(resource.get("resource")).get("attributes"))
            service = next((_dict(a.get("value")).get("stringValue") for a in attributes if a.get("key") == "service.name"), None)
            for scope in _list(resource.get("scopeSpans")) or _list(resource.get("instrumentationLibrarySpans")):
                for s in _list(scope.get("spans")):
                    if service:
                        yield "span", s.get("spanId") or s.get("span_id"), s.get("parentSpanId") or s.get("parent_span_id"), {"service": service, "scope": path}
    elif isinstance(doc, dict) and isinstance(doc.get("data"), list):
        for n, trace in enumerate(doc["data"]):
            names = {k: _dict(p).get("serviceName") for k, p in _dict(trace.get("processes")).items()}
            for s in _list(trace.get("spans")):
                service = names.get(s.get("processID"))
                if service:
                    parents = [r.get("spanID") for r in _list(s.get("references")) if r.get("refType") in ("CHILD_OF", "FOLLOWS_FROM")]
                    for p in parents or [None]:
                        yield "span", s.get("spanID"), p, {"service": service, "scope": f"{path}#{trace.get('traceID') or n}"}
    elif isinstance(doc, list) and any("localEndpoint" in _dict(s) or "traceId" in _dict(s) for s in doc):
        for s in doc:
            if service := _dict(s.get("localEndpoint")).get("serviceName"):
                yield "span", s.get("id"), s.get("parentId"), {"service": service, "scope": path}
    else:
        raise FormatError(f"{path}: no known trace format")


PARSERS: dict[str, Parser] = {
    "docker-compose": compose, "kubernetes": kubernetes, "github-actions": github_actions, "terraform": terraform, "python-imports": python_imports,
    "package-json": package_json, "cloudformation": cloudformation, "aws-cdk": aws_cdk, "pulumi": pulumi, "langgraph": langgraph, "crewai": crewai,
    "autogen": autogen, "otel-traces": traces,
}
