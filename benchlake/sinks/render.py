"""Small results as Markdown and JSON documents."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

EM_DASH = "—"


def cell(value: object, fmt: str = "{:.4f}") -> str:
    return "" if value is None else fmt.format(value) if isinstance(value, float) else str(value)


def md_table(headers: Sequence[str], rows: Iterable[Sequence[object]], fmt: str = "{:.4f}") -> str:
    out = [list(headers), ["---"] * len(headers), *([cell(v, fmt) for v in r] for r in rows)]
    return "\n".join("| " + " | ".join(r) + " |" for r in out)


def md(df: DataFrame, fmt: str = "{:.4f}") -> str:
    """A report frame (a row for each cell of a release) as a table."""
    return md_table(df.columns, (tuple(r) for r in df.collect()), fmt)


def ratio(value: float | None) -> str:
    return EM_DASH if value is None else f"{value:.2f}x"


def inject(text: str, start: str, end: str, body: str) -> str:
    """Replace what stands between two markers, which must be there once each and in order."""
    if text.count(start) != 1 or text.count(end) != 1 or text.index(start) > text.index(end):
        raise ValueError(f"markers {start!r} and {end!r} must each be there once, in order")
    head, _, rest = text.partition(start)
    _, _, tail = rest.partition(end)
    return f"{head}{start}\n{body}\n{end}{tail}"


def publish(document: dict[str, Any], path: Path, *, force: bool = False) -> None:
    """Write a snapshot in canonical JSON. What is published is frozen unless forced."""
    if path.exists() and not force:
        raise FileExistsError(f"{path} is published and frozen")
    path.parent.mkdir(parents=True, exist_ok=True)
    fresh = path.with_suffix(".tmp")
    fresh.write_text(json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
    fresh.replace(path)


def truncated(df: DataFrame, n: int) -> str:
    """The first n rows of a listing and how many there are in all."""
    total = df.count()
    rest = f"\n… and {total - n} more ({total} in all)" if total > n else ""
    return md(df.limit(n)) + rest


def rewrite(path: Path, bodies: dict[str, str], checks: DataFrame, out: Path | None = None) -> None:
    """Replace what stands between ``<!-- name -->`` and ``<!-- /name -->`` for every body, in one write and
    only if no row of checks (check, ok) fails."""
    if bad := [r["check"] for r in checks.filter("not ok").select("check").orderBy("check").collect()]:
        raise ValueError(f"nothing was written: {', '.join(bad)}")
    text = path.read_text()
    for name, body in sorted(bodies.items()):
        text = inject(text, f"<!-- {name} -->", f"<!-- /{name} -->", body)
    (out or path).write_text(text)


def page(document: dict[str, Any], name: str) -> str:
    """A snapshot as Markdown: every list of rows in it is a table."""
    parts = [f"# {document.get('version', name)}"]
    for key, rows in sorted(document.items()):
        for title, table in ([(key, rows)] if isinstance(rows, list) else [(f"{key}: {k}", v) for k, v in sorted(rows.items())] if isinstance(rows, dict) else []):
            if table and all(isinstance(r, dict) for r in table):
                headers = sorted({k for r in table for k in r})
                parts.append(f"## {title}\n\n" + md_table(headers, [[r.get(h) for h in headers] for r in table]))
    return "\n\n".join(parts) + "\n"


def replace_all(files: dict[Path, str]) -> list[Path]:
    """Write the files whose content differs from what is there, all of them or none: new contents are finished beside
    their targets first, and if one cannot be put in place, those already put are restored. Returns what was written."""
    digest = lambda data: hashlib.sha256(data).digest()
    changed = {p: t.encode() for p, t in sorted(files.items()) if not p.exists() or digest(p.read_bytes()) != digest(t.encode())}
    fresh, old, done = {}, {}, []
    try:
        for p, data in changed.items():
            p.parent.mkdir(parents=True, exist_ok=True)
            fresh[p] = p.with_name(f".{p.name}.new")
            fresh[p].write_bytes(data)
        for p in changed:
            old[p] = p.read_bytes() if p.exists() else None
            fresh[p].replace(p)
            done.append(p)
    except BaseException:
        for p in done:
            if old[p] is None:
                p.unlink()
            else:
                p.write_bytes(old[p])
        raise
    finally:
        for p in fresh.values():
            p.unlink(missing_ok=True)
    return done


def publication(root: Path, document: dict[str, Any] | None = None, path: Path | None = None) -> dict[Path, str]:
    """All files of a set of releases: each snapshot's page and the index of all, and of a new document its snapshot."""
    known = {p: json.loads(p.read_text()) for p in sorted(root.glob("*/data.json"))}
    if document is not None and path is not None:
        known[path] = document
    files = {p.with_name("index.md"): page(d, p.parent.name) for p, d in known.items()}
    if document is not None and path is not None:
        files[path] = json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
    names = sorted((str(d.get("version", p.parent.name)), p.parent.name) for p, d in known.items())
    if names:
        files[root / "index.md"] = "# Releases\n\n" + "\n".join(f"* [{version}]({folder}/index.md)" for version, folder in names) + "\n"
    return files


def release_set(root: Path, document: dict[str, Any], path: Path, *, force: bool = False) -> list[Path]:
    """Publish a snapshot and render every page under root, in one change. What is published is frozen unless forced."""
    if path.exists() and not force:
        raise FileExistsError(f"{path} is published and frozen")
    return replace_all(publication(root, document, path))


def rerender(root: Path) -> list[Path]:
    """A Markdown page beside every published snapshot ``<root>/*/data.json`` and an index of them; returns the pages that
    changed, without the index."""
    return [p for p in replace_all(publication(root)) if p.parent != root]
