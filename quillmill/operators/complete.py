"""Calls of a language model behind an injected function, and the JSON it answers with."""

from __future__ import annotations

import importlib
import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.profiles import DROPPED_KEYWORDS

Completer = Callable[[str], str]
Validator = Callable[[dict], list[str]]


def load(path: str) -> Any:
    """What `module:attribute` names."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def balanced(s: str) -> Iterator[str]:
    """Outermost {…} and […] blocks, strings respected."""
    depth, start, quoted, escaped = 0, 0, False, False
    for i, c in enumerate(s):
        if quoted:
            escaped, quoted = (c == "\\" and not escaped), not (c == '"' and not escaped)
        elif c == '"' and depth:
            quoted = True
        elif c in "{[":
            start, depth = (i if depth == 0 else start), depth + 1
        elif c in "}]" and depth:
            depth -= 1
            if depth == 0:
                yield s[start : i + 1]


def recover_json(s: str | None, key: str = "clauses") -> dict | None:
    """The object in an answer: the whole of it, a fenced part or the first block that parses; a list goes under `key`."""
    t = re.sub(r"^```\w*\s*|\s*```$", "", (s or "").strip())
    for part in (t, *balanced(t)):
        try:
            found = json.loads(part)
        except ValueError:
            continue
        if isinstance(found, list):
            return {key: found}
        if isinstance(found, dict):
            return found
    return None


class Paced:
    """A completer held to a rate in this task, tried again after growing waits; refusals are not tried again."""

    def __init__(self, call: Completer, per_second: float | None = None, waits: tuple[float, ...] = (1, 3, 7), sleep: Callable[[float], None] = time.sleep, now: Callable[[], float] = time.monotonic):
        self.call, self.gap, self.waits, self.sleep, self.now, self.last = call, 1 / per_second if per_second else 0, waits, sleep, now, None

    def __call__(self, prompt: str) -> str:
        for wait in (*self.waits, None):
            if self.last is not None and (rest := self.gap - (self.now() - self.last)) > 0:
                self.sleep(rest)
            self.last = self.now()
            try:
                return self.call(prompt)
            except PermissionError:
                raise
            except Exception:
                if wait is None:
                    raise
                self.sleep(wait)
        raise AssertionError


def first_json(modes: list[Completer], waits: tuple[float, ...] = (1.6, 2.56), sleep: Callable[[float], None] = time.sleep) -> Completer:
    """A completer that asks the modes in turn, a tool call before a plain JSON answer say, until one answers with JSON.

    Each mode is asked once more than there are waits; only a failure is waited for, an empty
    answer is asked again at once.  If no mode answers, the answer is empty.
    """

    def call(prompt: str) -> str:
        for mode in modes:
            for wait in (*waits, None):
                try:
                    answer = mode(prompt) or ""
                    if answer.strip():
                        json.loads(answer)
                        return answer
                except Exception:  # the next attempt or mode is the answer to any failure
                    if wait is not None:
                        sleep(wait)
        return ""

    return call


def extract_with_repair(prompt: str, complete: Completer, validate: Validator, budget: int = 3) -> tuple[dict | None, list[str], int]:
    """(object, errors, calls): asked again with what is wrong until nothing is, or the budget is spent."""
    ask, found, wrong, calls = prompt, None, ["no answer"], 0
    while calls < budget:
        calls += 1
        found = recover_json(complete(ask))
        wrong = ["no JSON object"] if found is None else validate(found)
        if not wrong:
            break
        ask = f"{prompt}\n\nRepair:\n{json.dumps(pruned(found), ensure_ascii=False, sort_keys=True)}\nErrors:\n" + "\n".join(wrong)
    return found, wrong, calls


def pruned(x: Any, most: int = 400) -> Any:
    """x with long strings cut, so that it fits into a prompt."""
    if isinstance(x, dict):
        return {k: pruned(v, most) for k, v in x.items()}
    if isinstance(x, list):
        return [pruned(v, most) for v in x]
    return x[:most] if isinstance(x, str) else x


ANSWER = "doc_id string, payload string, errors array<string>, calls long"


def extract_graphs(docs: DataFrame, make: Callable[[], Completer], prompt: Callable[[str], str], validate: Validator, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, payload JSON or null, errors, calls) for each document; a failed call is an error row, not a failed task.

    The completer is made once for each task.  Write the answers before using them twice: a task
    that runs again calls again.
    """
    own = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        complete = make()
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                try:
                    found, wrong, calls = extract_with_repair(prompt(t or ""), complete, validate, budget)
                except Exception as e:  # the service's failure is the row's result
                    found, wrong, calls = None, [f"{type(e).__name__}: {e}"], budget
                rows.append((json.dumps(found, ensure_ascii=False, sort_keys=True) if found is not None else None, wrong, calls))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.int64())], names=["doc_id", "payload", "errors", "calls"])

    return own.mapInArrow(run, ANSWER)


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) answers, for two sinks."""
    bad = F.size("errors") > 0
    return rows.where(~bad), rows.where(bad)


def allowed(types, permitted):
    """Types that are permitted, each once, in order."""
    return F.array_intersect(types, permitted)


# --- label trees and schemas ---


def flatten_labels(tree: Any, unique: bool = False) -> list[str]:
    """Labels of a tree of {label, children | childrens}, parents first; an envelope {data} is opened."""
    if isinstance(tree, dict) and "data" in tree and "label" not in tree:
        tree = tree["data"]
    out: list[str] = []
    todo = list(reversed(tree if isinstance(tree, list) else [tree]))
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if x.get("label"):
                out.append(x["label"])
            todo += reversed(x.get("children") or x.get("childrens") or [])
    return list(dict.fromkeys(out)) if unique else out


def prune_tree(tree: dict) -> dict:
    """The tree with labels and filled children only."""
    kids = [prune_tree(x) for x in tree.get("children") or tree.get("childrens") or []]
    return {"label": tree.get("label", "")} | ({"children": kids} if kids else {})


def strict_schema(s: Any) -> Any:
    """A JSON Schema as strict tool calls want it.

    All properties are required, those that were not may be null; open objects become lists of
    key and value; `$defs` is `$def`; an allOf of one is that one.
    """
    if isinstance(s, list):
        return [strict_schema(x) for x in s]
    if not isinstance(s, dict):
        return s
    if len(s.get("allOf", ())) == 1:
        return strict_schema({**{k: v for k, v in s.items() if k != "allOf"}, **s["allOf"][0]})
    out: dict = {}
    for k, v in s.items():
        if k in ("properties", "$defs", "$def"):
            out["$def" if k == "$defs" else k] = {n: strict_schema(x) for n, x in v.items()}
        elif k == "$ref":
            out[k] = v.replace("#/$defs/", "#/$def/")
        elif k not in DROPPED_KEYWORDS:
            out[k] = strict_schema(v)
    if out.get("type") == "object" or "properties" in out:
        props = out.get("properties") or {}
        if not props:
            pair = {"type": "object", "properties": {"k": {"type": "string"}, "v": {"type": "string"}}, "required": ["k", "v"], "additionalProperties": False}
            return {"type": "array", "items": pair}
        must = set(s.get("required", ()))
        out["properties"] = {n: x if n in must else {"anyOf": [x, {"type": "null"}]} for n, x in props.items()}
        out |= {"type": "object", "required": list(props), "additionalProperties": False}
    return out


def lint_strict(s: Any, at: str = "$") -> list[str]:
    """Where a schema is not strict."""
    if isinstance(s, list):
        return [e for i, x in enumerate(s) for e in lint_strict(x, f"{at}[{i}]")]
    if not isinstance(s, dict):
        return []
    wrong = [f"{at}: {k}" for k in s if k in DROPPED_KEYWORDS]
    if s.get("type") == "object" and (s.get("additionalProperties") is not False or set(s.get("required", ())) != set(s.get("properties", ()))):
        wrong.append(f"{at}: open object")
    named = ("properties", "$def")
    return wrong + [e for k, v in s.items() for e in ([y for n, x in v.items() for y in lint_strict(x, f"{at}.{n}")] if k in named else lint_strict(v, f"{at}.{k}"))]


def tool_of(spec: Any) -> dict:
    """The first tool of a parsed file: a tool, a list of tools or an object with `tools`; ValueError for what names no function."""
    tools = spec.get("tools", [spec] if spec.get("type") == "function" else None) if isinstance(spec, dict) else spec
    if not isinstance(tools, list) or not tools:
        raise ValueError("neither a tool nor a list of tools")
    if not (isinstance(tools[0], dict) and tools[0].get("function", {}).get("name")):
        raise ValueError("the tool names no function")
    return tools[0]


def case_graph(answer: dict, doc: dict, raw_text: str) -> dict:
    """An answer as a whole graph of a case: what it lacks comes from the document or is a default, lists are lists.

    What the answer has stays, null too, but for the lists, the source and the text, which are the document's.
    """
    about = doc.get("meta") or {}
    level = (about.get("trial_level") or "").strip()
    named = [stage for stage, levels in profiles.PROCEDURE_STAGES if level in levels]
    stage = named[0] if named else "retrial" if "再审" in level or level == "retrial" else profiles.PROCEDURE_STAGES[0][0]
    known = {**profiles.CASE_PLACE, "court": about.get("court"), "case_type": doc.get("subtype") or about.get("cause") or about.get("case_system"), "cause": about.get("cause"), "procedure_stage": stage}
    whole = {"case_id": str(doc.get("doc_id", "")).strip() or "UNKNOWN_DOC", "schema_version": profiles.CASE_VERSION, "summary": None, **answer}
    lists = {k: whole[k] if isinstance(whole.get(k), list) else [] for k in profiles.CASE_LISTS}
    return {**whole, **lists, "source_type": profiles.CASE_SOURCE, "raw_text": raw_text, "meta": {**known, **(answer.get("meta") or {})}}


def for_output(graph: dict, doc_id: str, keep_text: bool = False) -> dict:
    """A graph with its document's id, its text emptied unless it is to be kept."""
    text = {} if keep_text or "raw_text" not in graph else {"raw_text": ""}
    return {"doc_id": doc_id, **graph, **text}


def case_graphs(answers: DataFrame, docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """(doc_id, payload) of answers (doc_id, payload JSON) as whole graphs; docs are (doc_id, doc JSON, text).

    Answers without an object or a document are left out.  The join moves answers and texts once.
    """
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "doc", F.coalesce("text", F.lit("")).alias("text"))
    both = answers.where("payload is not null").select(F.col("doc_id").cast("string").alias("doc_id"), "payload").join(d, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, payload, doc, text in zip(*(c.to_pylist() for c in b.columns)):
                answer, about = recover_json(payload), recover_json(doc) or {}
                whole = case_graph(answer, {"doc_id": doc_id, **about}, text) if answer is not None else None
                out.append(json.dumps(for_output(whole, doc_id, keep_text), ensure_ascii=False, sort_keys=True) if whole else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "payload"])

    return both.mapInArrow(run, "doc_id string, payload string").where("payload is not null")
