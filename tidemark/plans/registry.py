"""Extension points by name (X1-X10): filters, converters, readers, plugins, and programs run per partition."""

from __future__ import annotations

import json
import subprocess
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import PROGRAM_CODES, ConfigError
from tidemark.functions import arrays, times, values
from tidemark.operators import link, select
from tidemark.sources import binaries, folders, names, texts
from tidemark.streaming.schedule import Plugin

FILTERS: dict[str, Callable[..., DataFrame]] = {"latest_per_key": select.latest_per_key, "latest": select.latest, "within_horizon": select.within_horizon, "split_linked": link.split_linked}
CONVERTERS: dict[str, Callable[..., Column]] = {
    "time": times.formatted, "yyyymmddhh_time": times.shifted, "levels": lambda c: c, "latitude": values.checked_latitude, "longitude": values.checked_longitude,
    "transpose2D": arrays.transposed, "transpose3D": lambda m: F.transform(m, arrays.transposed), "convert2float": lambda c: c.cast("double"), "knots": values.knots,
}
READERS = dict(names.KINDS)
PLUGINS: dict[str, Plugin | Callable[..., Plugin]] = {}
ACTIONS: dict[str, Callable[..., DataFrame]] = {"list": folders.listed, "members": binaries.members, "headers": binaries.headers}  # X6
INPUTS: dict[str, Callable[..., DataFrame]] = {"control": texts.control_input}  # X9


def register(kind: dict, name: str):  # noqa: ANN201
    """Adds a function or object under a name: @register(FILTERS, "mine")."""

    def add(thing):  # noqa: ANN001, ANN202
        kind[name] = thing
        return thing

    return add


def found(kind: dict, name: str):  # noqa: ANN201
    if name not in kind:
        raise ConfigError(f"unknown: {name}; known: {', '.join(sorted(kind))}")
    return kind[name]


def plugin(name: str, *inputs) -> Plugin:  # noqa: ANN002
    """A plugin by name; those that need more than a listing are made of ``inputs``."""
    thing = found(PLUGINS, name)
    return thing if isinstance(thing, Plugin) else thing(*inputs)


def converted(df: DataFrame, outputs: dict[str, dict]) -> DataFrame:
    """Output columns from data columns: {name: {"from": [columns], "convert": name or None, "args": [...]}}."""
    cols = []
    for name, spec in outputs.items():
        if missing := [c for c in spec["from"] if c not in df.columns]:
            raise ConfigError(f"{name}: no column {', '.join(missing)}")
        inputs = [F.col(c) for c in spec["from"]]
        cols.append((found(CONVERTERS, spec["convert"])(*inputs, *spec.get("args", [])) if spec.get("convert") else inputs[0]).alias(name))
    return df.select(*cols)


def config(path: str) -> dict:
    """A JSON configuration, keys in order."""
    return json.loads(Path(path).read_text())


def validated(tree: dict, required: dict[str, type]) -> str | None:
    """None, or the messages in key order."""
    wrong = [f"{k}: missing" if k not in tree else f"{k}: not {t.__name__}" for k, t in sorted(required.items()) if k not in tree or not isinstance(tree[k], t)]
    return "; ".join(wrong) or None


def replaced(tree: dict, key_pattern: str, change: Callable, *args) -> dict:  # noqa: ANN001, ANN002
    """A copy of a nested configuration with the values of matching keys changed; lists stay as they are."""
    import re

    test = re.compile(key_pattern)
    return {k: replaced(v, key_pattern, change, *args) if isinstance(v, dict) else change(v, *args) if test.match(k) else v for k, v in tree.items()}


def run_program(df: DataFrame, keys: list[str], command: Callable[[dict], list[str]], timeout: int = 600) -> DataFrame:
    """An external program once for each row of keys: the keys, exit code, what it means, success, standard output.

    Rows go to their own tasks, so programs run across the cluster; a program that fails or can't start is a row, not an error.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                try:
                    done = subprocess.run(command(row), capture_output=True, text=True, timeout=timeout)
                    rows.append((*(row[k] for k in keys), done.returncode, PROGRAM_CODES.get(done.returncode), done.returncode == 0, done.stdout))
                except (OSError, subprocess.TimeoutExpired) as error:
                    rows.append((*(row[k] for k in keys), -1, str(error), False, ""))
            yield pd.DataFrame(rows, columns=[*keys, "code", "meaning", "ok", "stdout"])

    spread = df.select(*keys).distinct()
    return spread.repartition(*keys).mapInPandas(run, f"{kinds}, code int, meaning string, ok boolean, stdout string")
