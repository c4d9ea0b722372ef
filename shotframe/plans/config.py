"""The configuration language: two YAML documents, a header and the tasks' parameters, with {{ name:format }}."""

from __future__ import annotations

import os
import re
from pathlib import Path
from typing import Any

_REFERENCE = re.compile(r"\{\{([^}{]*)\}\}")


def coerce(text: str) -> int | float | str:
    """Digits as a whole number, else a number, else the text."""
    if text.isnumeric():
        try:
            return int(text)
        except ValueError:
            return text
    try:
        return float(text)
    except ValueError:
        return text


def _look_up(name: str, header: dict, tasks: dict, env_prefix: str) -> Any:
    if name.startswith("$"):
        value = os.environ.get(name[1:], os.environ.get(env_prefix + name[1:]) if env_prefix else None)
        return None if value is None else coerce(value)
    at: Any = tasks
    for key in name.split("."):
        if not isinstance(at, dict) or key not in at:
            return header[name]
        at = at[key]
    return at


def substitute(header: dict, tasks: dict, env_prefix: str = "TENV_") -> dict:
    """tasks with every reference replaced: a dotted path into the tasks, else a name in the header, or $VARIABLE of
    the environment (also under env_prefix); unset variables leave the text as it is. Text that held a reference
    and now reads as a number becomes one. Numbers, and text inside lists, are left alone."""

    def fill(m: re.Match) -> str:
        name, _, form = m[1].strip().partition(":")
        value = _look_up(name.strip(), header, tasks, env_prefix)
        return m[0] if value is None else format(value, form.strip())

    def walk(at: dict) -> None:
        for k, v in at.items():
            if isinstance(v, dict):
                walk(v)
            elif isinstance(v, str):
                at[k] = coerce(_REFERENCE.sub(fill, v))

    walk(tasks)
    return tasks


def load(path: str, env_prefix: str = "TENV_") -> tuple[dict, dict]:
    """(header, tasks) of a file of two documents, in either order the header first."""
    import yaml

    header, tasks = yaml.safe_load_all(Path(path).read_text())
    return header, substitute(header, tasks or {}, env_prefix)


def arguments(values: dict[str, Any], fields: dict[str, dict] | None = None, short_eq: bool = False, long_eq: bool = False) -> list[str]:
    """Command-line words of parameters. fields: of each, flag ('-', '--' or '' for a positional one) and name.

    None and '' are left out; a true '--' switch stands alone and a false one is left out; a field that is not
    described is '-x' for one letter, positional with p_arg in its name, else '--name'. Text with spaces becomes
    several words."""
    out: list[str] = []
    for key, value in values.items():
        if value is None or value == "":
            continue
        f = (fields or {}).get(key, {})
        name = f.get("name", key)
        flag = f.get("flag", "-" if len(key) == 1 else "" if "p_arg" in key else "--")
        if flag == "--" and isinstance(value, bool):
            out += [f"--{name}"] if value else []
            continue
        if flag and (short_eq if flag == "-" else long_eq):
            out.append(f"{flag}{name}={value}")
            continue
        if flag:
            out.append(flag + name)
        out += value.split() if isinstance(value, str) and " " in value else [str(value)]
    return out


def render(template: str, values: dict[str, Any]) -> str:
    """A template's {{ name }} replaced by values; unknown names stay."""
    return _REFERENCE.sub(lambda m: str(values.get(m[1].strip(), m[0])), template)
