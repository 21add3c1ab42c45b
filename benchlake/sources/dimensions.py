"""Declared dimensions: registry and ledger in YAML, strictly checked, as small frames."""

from __future__ import annotations

import re
from typing import Any

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession

# The fields of the declared files.
REGISTRY_FIELDS = ("id", "pr", "date", "summary", "affected", "expected_drift_pct")
LEDGER_FIELDS = ("to_sha", "pr", "date", "summary", "expected_drift_pct")
METRICS = ("concordance", "confident_relocation")
SAMPLE_FIELDS, SAMPLE_OPTIONS = ("reference", "source", "layout"), ("baseline_tool", "flags", "compare_options", "truth", "meth", "alt_aware", "compat")
ARCH_FIELDS, ARCH_OPTIONS = ("instance_type", "simd", "platform"), ("batch_queue", "baseline_arch")


def _entries(text: str, name: str, required: tuple[str, ...], optional: tuple[str, ...]) -> list[dict[str, Any]]:
    entries = (yaml.safe_load(text) or {}).get(name) or []
    for k, e in enumerate(entries):
        if absent := [f for f in required if f not in e]:
            raise ValueError(f"{name}[{k}] lacks {', '.join(absent)}")
        if strange := sorted(set(e) - {*required, *optional}):
            raise ValueError(f"{name}[{k}] has unknown keys {', '.join(strange)}")
    return entries


def registry(spark: SparkSession, text: str) -> DataFrame:
    """Expected divergences: (id, samples, metric, expected_drift_pct, gating, ...). A single sample may
    be a plain string; no list means every sample."""
    rows = []
    for k, e in enumerate(_entries(text, "divergences", REGISTRY_FIELDS, ("samples", "metric", "gating"))):
        samples, metric, gating = e.get("samples") or [], e.get("metric", METRICS[0]), e.get("gating", True)
        samples = [samples] if isinstance(samples, str) else samples
        if not isinstance(samples, list):
            raise ValueError(f"divergences[{k}].samples is neither a string nor a list")
        if metric not in METRICS:
            raise ValueError(f"divergences[{k}].metric is none of {METRICS}")
        if not isinstance(gating, bool):
            raise ValueError(f"divergences[{k}].gating is no boolean")
        rows.append((*(str(e[f]) for f in REGISTRY_FIELDS[:-1]), float(e["expected_drift_pct"]), [str(s) for s in samples], metric, gating))
    return spark.createDataFrame(rows, "id string, pr string, date string, summary string, affected string, expected_drift_pct double, samples array<string>, metric string, gating boolean")


def ledger(spark: SparkSession, text: str) -> DataFrame:
    """Release ledger: (ordinal, to_sha, pr, date, summary, expected_drift_pct, aliases)."""
    rows = []
    for k, e in enumerate(_entries(text, "allowances", LEDGER_FIELDS, ("aliases",))):
        aliases = e.get("aliases") or []
        if not isinstance(aliases, list):
            raise ValueError(f"allowances[{k}].aliases is no list")
        rows.append((k, *(str(e[f]) for f in LEDGER_FIELDS[:-1]), float(e["expected_drift_pct"]), [str(a) for a in aliases]))
    return spark.createDataFrame(rows, "ordinal long, to_sha string, pr string, date string, summary string, expected_drift_pct double, aliases array<string>")


def _named(text: str, name: str, required: tuple[str, ...], optional: tuple[str, ...]) -> dict[str, dict[str, Any]]:
    entries = (yaml.safe_load(text) or {}).get(name) or {}
    for k, e in entries.items():
        if absent := [f for f in required if f not in e]:
            raise ValueError(f"{name}.{k} lacks {', '.join(absent)}")
        if strange := sorted(set(e) - {*required, *optional}):
            raise ValueError(f"{name}.{k} has unknown keys {', '.join(strange)}")
    return entries


_SAMPLES = "sample string, reference string, source string, layout string, baseline_tool string, flags array<string>, truth boolean, meth boolean, compat boolean, alt_aware boolean, base string"


def _sample_rows(text: str) -> list[tuple]:
    rows = []
    for name, e in _named(text, "samples", SAMPLE_FIELDS, SAMPLE_OPTIONS).items():
        flags = [str(f) for f in e.get("flags") or []]
        for f in ("truth", "meth", "alt_aware", "compat"):
            if not isinstance(e.get(f, False), bool):
                raise ValueError(f"samples.{name}.{f} is no boolean")
        compat = e.get("compat", "-compat" in name)
        base = re.sub(r"-(fast|compat[a-z0-9-]*)$", "", name)
        rows.append((name, *(str(e[f]) for f in SAMPLE_FIELDS), e.get("baseline_tool"), flags, e.get("truth", False), e.get("meth", False), compat, e.get("alt_aware", False), base))
    return rows


def samples(spark: SparkSession, text: str) -> DataFrame:
    """Samples with what plans ask of them, and ``base``, the sample a compat or fast one is compared with."""
    return spark.createDataFrame(_sample_rows(text), _SAMPLES)


def samples_of(files: DataFrame) -> DataFrame:
    """Samples of many configuration files (path, value), such as the copies that runs keep of theirs, with the path."""

    def parse(batches):
        for b in batches:
            rows = [(path, *row) for path, text in zip(b["path"], b["value"], strict=True) for row in _sample_rows(text)]
            yield pd.DataFrame(rows, columns=names)

    names = ["path", *(c.split()[0] for c in _SAMPLES.split(", "))]
    return files.select("path", "value").mapInPandas(parse, f"path string, {_SAMPLES}")


def no_samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _SAMPLES)


def archs(spark: SparkSession, text: str) -> DataFrame:
    """Architectures: (arch, instance_type, simd, platform, batch_queue, baseline_arch). An arch without a
    reference of its own is one: baseline_arch is then the arch itself."""
    rows = [(name, *(str(e[f]) for f in ARCH_FIELDS), e.get("batch_queue"), e.get("baseline_arch", name)) for name, e in _named(text, "archs", ARCH_FIELDS, ARCH_OPTIONS).items()]
    known = {r[0] for r in rows}
    if wrong := sorted(r[0] for r in rows if r[-1] not in known):
        raise ValueError(f"archs without a known baseline_arch: {', '.join(wrong)}")
    return spark.createDataFrame(rows, "arch string, instance_type string, simd string, platform string, batch_queue string, baseline_arch string")


def ladder(text: str, *, whole: bool = False) -> list[tuple[int, int]]:
    """``threads:replicates`` rungs, "16:3,64:3", in order of threads. A whole ladder has a one-thread rung."""
    rungs = []
    for token in filter(None, (t.strip() for t in text.split(","))):
        m = re.fullmatch(r"([0-9]+) *: *([0-9]+)", token)
        if not m or min(int(m[1]), int(m[2])) < 1:
            raise ValueError(f"{token!r} is not threads:replicates, both 1 or more")
        rungs.append((int(m[1]), int(m[2])))
    if not rungs or len({t for t, _ in rungs}) < len(rungs):
        raise ValueError(f"{text!r} has no rung or repeats one")
    if whole and 1 not in {t for t, _ in rungs}:
        raise ValueError(f"{text!r} has no one-thread rung")
    return sorted(rungs)


def defaults(text: str) -> dict[str, Any]:
    """Thread ladder and gate tolerance of a defaults file, checked: a tolerance that is not finite would
    switch its gate off."""
    raw = (yaml.safe_load(text) or {}).get("thread_scaling") or {}
    drop = raw.get("max_efficiency_drop_pp")
    if isinstance(drop, bool) or not isinstance(drop, int | float) or not 0 <= drop < float("inf"):
        raise ValueError(f"max_efficiency_drop_pp must be a finite number of 0 or more, not {drop!r}")
    return {"ladder": ladder(str(raw.get("ladder", "")), whole=True), "max_efficiency_drop_pp": float(drop)}


def option_clashes(tokens: list[str], short: str, long: tuple[str, ...], takes_value: str) -> list[str]:
    """Tokens that set an option which is not theirs to set, read as getopt does: a bundle of short options
    is cut by the first that takes a value, and a long option may be abbreviated."""
    out, skip = [], False
    for token in tokens:
        if skip:
            skip = False
        elif token.startswith("--"):
            name = token[2:].partition("=")[0]
            if any(option.startswith(name) for option in long):
                out.append(token)
        elif re.fullmatch(r"-.+", token):
            bundle = re.match(rf"[^{re.escape(takes_value)}]*.?", token[1:])[0]  # up to the first that takes a value
            if set(bundle) & set(short):
                out.append(token)
            skip = len(bundle) == len(token) - 1 and bundle[-1] in takes_value
    return out
