"""The declarative configuration: strict YAML, rule files, inheritance, validation."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Any

import yaml

from loomgraph.operators.values import LEARNED, OPERATORS, Env, step

DEFAULT_PRE_OPS = ["fix_encoding", "strip_html", "collapse_ws", "strip_chars"]


class ConfigError(ValueError):
    pass


class _Strict(yaml.SafeLoader):
    """Refuses a key that occurs twice in one block."""


def _mapping(loader: _Strict, node: yaml.MappingNode) -> dict:
    out: dict = {}
    for k, v in node.value:
        key = loader.construct_object(k, deep=True)
        if key in out:
            raise ConfigError(f"key {key!r} occurs twice, line {k.start_mark.line + 1}")
        out[key] = loader.construct_object(v, deep=True)
    return out


_Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _mapping)


def merged(below: Any, above: Any) -> Any:
    """Mappings merge key by key; scalars and lists of ``above`` replace."""
    if isinstance(below, dict) and isinstance(above, dict):
        return below | {k: merged(below.get(k), v) if k in below else v for k, v in above.items()}
    return above


@dataclass
class RelationPlan:
    name: str
    sources: list[str]
    ops: list[Any]
    pre_ops: list[Any]
    first_source_only: bool = True
    fallback_for: str | None = None
    subsumed_by: list[str] = field(default_factory=list)

    @property
    def pipeline(self) -> list[Any]:
        return [*self.pre_ops, *self.ops]

    @property
    def learns(self) -> bool:
        return any(n in LEARNED or n == "split_smart" and p.get("mode", "evidence") == "evidence" for n, p in filter(None, map(step, self.ops)))


@dataclass
class Plan:
    category: str
    relations: list[RelationPlan]
    rules: dict[str, Any]
    persons: dict[str, Any]
    subject: dict[str, Any]
    text: dict[str, Any]
    image: dict[str, Any]
    id_field: str = "parent_asin"
    drop_without_subject: bool = True
    min_relations: int = 0

    def env(self, relation: str) -> Env:
        return Env(self.rules, self.persons, relation)

    @property
    def two_passes(self) -> bool:
        return any(r.learns for r in self.relations)


class Config:
    def __init__(self, tree: dict[str, Any], rules: dict[str, Any] | None = None):
        self.tree = tree or {}
        self.rules = rules or {}

    @classmethod
    def parse(cls, text: str, rules: dict[str, Any] | None = None) -> Config:
        return cls(yaml.load(text, _Strict), rules)  # noqa: S506

    @classmethod
    def load(cls, path: str) -> Config:
        """The YAML file and the rule files it names, relative to it; a rule file that is missing counts as empty."""
        with open(path, encoding="utf-8") as f:
            tree = yaml.load(f, _Strict)  # noqa: S506
        rules = {}
        for alias, name in (tree.get("rules_files") or {}).items():
            at = os.path.join(os.path.dirname(os.path.abspath(path)), name)
            if os.path.exists(at):
                with open(at, encoding="utf-8") as f:
                    rules[alias] = json.load(f)
        return cls(tree, rules)

    @property
    def categories(self) -> list[str]:
        return [c for c in self.tree.get("categories") or {} if not str(c).startswith("_")]

    def chain(self, category: str) -> list[dict]:
        """The blocks of a category from its root to itself."""
        blocks, seen = [], []
        at: str | None = category
        while at:
            if at in seen:
                raise ConfigError(f"inheritance runs in a circle: {' > '.join([*seen, at])}")
            block = (self.tree.get("categories") or {}).get(at)
            if block is None and at == category and "_generic" in (self.tree.get("categories") or {}):
                block = {"inherit": "_generic"}
            elif block is None:
                raise ConfigError(f"unknown category {at!r}")
            seen.append(at)
            blocks.insert(0, block or {})
            at = (block or {}).get("inherit")
        return blocks

    def plan(self, category: str) -> Plan:
        defaults = self.tree.get("defaults") or {}
        whole: dict[str, Any] = {"relations": dict(defaults.get("global_relations") or {})}
        for block in self.chain(category):
            whole = merged(whole, {k: v for k, v in block.items() if k != "inherit"})
        relations = []
        for name, spec in whole["relations"].items():
            if not spec:
                continue  # null or false takes a relation away
            pre = spec["pre_ops"] if "pre_ops" in spec else defaults.get("pre_ops", DEFAULT_PRE_OPS)
            subsumed = spec.get("subsumed_by") or []
            relations.append(
                RelationPlan(
                    name, list(spec.get("sources") or []), list(spec.get("ops") or []), list(pre or []), bool(spec.get("first_source_only", True)),
                    spec.get("fallback_for"), [subsumed] if isinstance(subsumed, str) else list(subsumed),
                )
            )
        part = lambda k: merged(defaults.get(k) or {}, whole.get(k) or {})
        persons = self.person_rules(whole.get("person_rules") or defaults.get("person_rules") or [])
        return Plan(
            category, relations, self.rules, persons, part("subject"), part("text"), part("image"), defaults.get("id_field", "parent_asin"),
            bool(defaults.get("drop_products_without_subject", True)), int(whole.get("min_relations", defaults.get("min_relations", 0)) or 0),
        )

    def person_rules(self, paths: str | list[str]) -> dict[str, Any]:
        """The rules for persons of one or several rule tables: later aliases replace earlier ones, lists add up."""
        out: dict[str, Any] = {"person_mappings": {}}
        for path in [paths] if isinstance(paths, str) else paths:
            for k, v in Env(self.rules).rule(str(path), dict).items():
                if k == "person_mappings":
                    out[k] = out[k] | (v or {})
                elif k.startswith("person_"):
                    out[k] = [*out.get(k, []), *(v or [])]
        return out

    def validate(self) -> list[str]:
        """Problems: unknown operations, relations without sources, references to rules that lead nowhere, circles."""
        out = []
        for category in self.categories:
            try:
                plan = self.plan(category)
            except ConfigError as e:
                out.append(f"{category}: {e}")
                continue
            for r in plan.relations:
                if not r.sources:
                    out.append(f"{category}.{r.name}: no sources")
                for name, params in filter(None, map(step, r.pipeline)):
                    if name not in OPERATORS:
                        out.append(f"{category}.{r.name}: unknown operation {name!r}")
                    for ref in ("rules_ref", "bins_ref", "type_rules_ref", "keep_whole_ref", "keep_distinct_ref"):
                        if params.get(ref) and not plan.env(r.name).rule(params[ref], dict) and not plan.env(r.name).rule(params[ref], list):
                            out.append(f"{category}.{r.name}: {ref} {params[ref]!r} leads nowhere")
        return out

    def alias_report(self) -> list[dict[str, Any]]:
        """Per rule table with aliases of persons: mappings, canonical forms, variants attached, chains (a target that is an alias itself) and
        circles (chains that come back to their start)."""
        from loomgraph.functions.persons import alias_clusters

        out = []
        for name, table in self.rules.items():
            pairs = table.get("person_mappings") if isinstance(table, dict) else None
            if not pairs:
                continue
            clusters = alias_clusters(pairs)

            def circles(start: str, pairs: dict = pairs) -> bool:
                at, seen = pairs.get(start), {start}
                while at is not None and at not in seen:
                    seen.add(at)
                    at = pairs.get(at)
                return at == start

            out.append({
                "rules": name, "mappings": len(pairs), "canonical": len(set(clusters.values())), "variants": len(clusters),
                "chains": sum(target in pairs for target in pairs.values()), "circles": sum(map(circles, pairs)),
            })
        return out
