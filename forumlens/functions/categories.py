"""Community categories, tool names and breadth classes as native CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens import vocab


def _case(conditions: Sequence[tuple[str, Column]], default: Column | None) -> Column:
    (first_label, first_condition), *rest = conditions
    expr = F.when(first_condition, F.lit(first_label))
    for label, condition in rest:
        expr = expr.when(condition, F.lit(label))
    return expr if default is None else expr.otherwise(default)


def by_name(community: str = "subreddit", mapping: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Category by exact community name; NULL when no category lists it."""
    mapping = mapping or vocab.SIX_WAY_CATEGORY
    return _case([(k, F.col(community).isin(*v)) for k, v in mapping.items()], None)


def by_folded_name(
    community: str = "subreddit", mapping: Mapping[str, Sequence[str]] | None = None, default: str = "Other"
) -> Column:
    """Category by lower-cased, trimmed name, with a default."""
    mapping = mapping or vocab.FOUR_WAY_CATEGORY
    folded = F.lower(F.trim(F.col(community)))
    return _case([(k, folded.isin(*v)) for k, v in mapping.items()], F.lit(default))


def by_substring(
    community: str = "subreddit", mapping: Mapping[str, Sequence[str]] | None = None, default: str = "Other"
) -> Column:
    """Category of the first entry that holds a substring of the lower-cased name."""
    mapping = mapping or vocab.FIVE_WAY_SUBSTRINGS
    folded = F.lower(F.col(community))
    conditions = []
    for label, parts in mapping.items():
        condition = folded.contains(parts[0])
        for part in parts[1:]:
            condition = condition | folded.contains(part)
        conditions.append((label, condition))
    return _case(conditions, F.lit(default))


def tool_name(community: str = "subreddit", tools: Sequence[str] = tuple(vocab.AI_TOOLS)) -> Column:
    """Canonical tool name when the community is one of the tools (any case), else NULL."""
    upper = F.upper(F.trim(F.col(community)))
    return _case([(tool, upper == tool.upper()) for tool in tools], None)


def mentions_pattern(names: Sequence[str] = tuple(vocab.AI_TOOL_MENTIONS)) -> str:
    return r"\b(" + "|".join(names) + r")\b"


def mentions_tool(text: Column, names: Sequence[str] = tuple(vocab.AI_TOOL_MENTIONS)) -> Column:
    """True when the lower-cased text names an AI tool; NULL text does not."""
    return F.coalesce(F.lower(text).rlike(mentions_pattern(names)), F.lit(False))


def with_baseline_mentions(
    category: Column,
    text: Column,
    baseline: str = "Baseline (AskReddit)",
    label: str = vocab.BASELINE_MENTION_LABEL,
) -> Column:
    """Give baseline posts that mention a tool a category of their own."""
    return F.when((category == baseline) & mentions_tool(text), F.lit(label)).otherwise(category)


def breadth_class(num_communities: Column) -> Column:
    return (
        F.when(num_communities == 1, F.lit("specialist"))
        .when(num_communities <= 3, F.lit("broad"))
        .otherwise(F.lit("generalist"))
    )


def persona(cluster: Column, names: Mapping[int, str] | None = None) -> Column:
    """Persona label of a cluster id; `Cluster n` when the id has none."""
    fallback = F.concat(F.lit("Cluster "), cluster.cast("string"))
    if not names:
        return fallback
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), cluster.cast("int")), fallback)
