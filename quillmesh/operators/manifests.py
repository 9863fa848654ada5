"""Manifests of packages, read into one fixed shape."""

from __future__ import annotations

import configparser
import json
import re
import tomllib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())
SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("surface_kind", "pkg_name")]
    + [T.StructField(n, _TEXTS) for n in ("exports", "bin", "entry_points", "public_names", "runtime", "peer")]
    + [T.StructField(n, T.StringType()) for n in ("requires_python", "engine", "install")]
    + [T.StructField("monorepo", T.BooleanType()), T.StructField("errors", _TEXTS)]
)
EMPTY = {
    "surface_kind": "none", "pkg_name": "", "exports": [], "bin": [], "entry_points": [], "public_names": [], "runtime": [], "peer": [],
    "requires_python": "", "engine": "", "install": "", "monorepo": False, "errors": [],
}


def _filled(kind: str, **values) -> dict:
    return {**EMPTY, "surface_kind": kind, **values}


def _bare(requirement: str) -> str:
    """The name of a requirement such as ``name[extra]>=1; marker``."""
    found = re.match(r"\s*([A-Za-z0-9][\w.-]*)", requirement)
    return found.group(1) if found else ""


def _names(requirements) -> list[str]:
    return list(dict.fromkeys(filter(None, map(_bare, requirements))))


def package_json(text: str) -> dict:
    data = json.loads(text)
    name, exports, scripts = data.get("name") or "", data.get("exports"), data.get("bin")
    if isinstance(exports, dict):
        exports = [k for k in exports if k.startswith(".")] or ["."]
    else:
        exports = ["."] if exports or data.get("main") or data.get("module") else []
    scripts = list(scripts) if isinstance(scripts, dict) else [name.rpartition("/")[2]] if isinstance(scripts, str) and name else []
    monorepo = bool(data.get("workspaces"))
    return _filled(
        "npm", pkg_name=name, exports=exports, bin=scripts, public_names=[name] if name else [], runtime=list(data.get("dependencies") or {}),
        peer=list(data.get("peerDependencies") or {}), engine=str((data.get("engines") or {}).get("node") or ""), monorepo=monorepo,
        install="pnpm install" if monorepo else f"npm install {name}" if name else "",
    )


def pyproject(text: str) -> dict:
    data = tomllib.loads(text)
    project, poetry = data.get("project") or {}, (data.get("tool") or {}).get("poetry") or {}
    name = project.get("name") or poetry.get("name") or ""
    needs = poetry.get("dependencies") or {}
    runtime = _names(project["dependencies"]) if "dependencies" in project else [n for n in needs if n != "python"]
    groups = project.get("entry-points") or poetry.get("plugins") or {}
    python = project.get("requires-python") or needs.get("python") or ""
    return _filled(
        "python", pkg_name=name, bin=list(project.get("scripts") or poetry.get("scripts") or {}), entry_points=[f"{g}/{n}" for g, names in groups.items() for n in names],
        public_names=[name.replace("-", "_").lower()] if name else [], runtime=runtime, requires_python=str(python), install=f"pip install {name}" if name else "",
    )


#: A list of quoted strings, which may hold brackets and the other quote; and such a string.
QUOTED_LIST = r"\[((?:[^\]'\"]|'[^']*'|\"[^\"]*\")*)\]"
QUOTED = re.compile(r"'([^']+)'|\"([^\"]+)\"")


def setup_py(text: str) -> dict:
    def value(key: str) -> str:
        found = re.search(rf"\b{key}\s*=\s*['\"]([^'\"]+)['\"]", text)
        return found.group(1) if found else ""

    def strings(before: str) -> list[str]:
        found = re.search(before + QUOTED_LIST, text)
        return [one or two for one, two in QUOTED.findall(found.group(1))] if found else []

    name = value("name")
    scripts = [s.partition("=")[0].strip() for s in strings(r"console_scripts['\"]\s*:\s*")]
    return _filled(
        "python", pkg_name=name, bin=scripts, public_names=strings(r"__all__\s*=\s*") or ([name] if name else []), runtime=_names(strings(r"install_requires\s*=\s*")),
        requires_python=value("python_requires"), install=f"pip install {name}" if name else "",
    )


def setup_cfg(text: str) -> dict:
    config = configparser.ConfigParser(interpolation=None)
    config.read_string(text)

    def lines(section: str, key: str) -> list[str]:
        return [x.strip() for x in config.get(section, key, fallback="").splitlines() if x.strip()]

    name = config.get("metadata", "name", fallback="")
    return _filled(
        "python", pkg_name=name, bin=[x.partition("=")[0].strip() for x in lines("options.entry_points", "console_scripts")], public_names=[name] if name else [],
        runtime=_names(lines("options", "install_requires")), requires_python=config.get("options", "python_requires", fallback=""), install=f"pip install {name}" if name else "",
    )


def go_mod(text: str) -> dict:
    module, version = re.search(r"^module\s+(\S+)", text, re.MULTILINE), re.search(r"^go\s+(\S+)", text, re.MULTILINE)
    blocks = re.findall(r"^require\s*\((.*?)^\)", text, re.MULTILINE | re.DOTALL)
    needed = [m for block in blocks for m in re.findall(r"^\s*([^\s/(][^\s]*)\s+v\S+", block, re.MULTILINE)]
    needed += re.findall(r"^require\s+([^\s(]+)\s+v\S+", text, re.MULTILINE)
    name = module.group(1) if module else ""
    return _filled("go", pkg_name=name, public_names=[name] if name else [], runtime=list(dict.fromkeys(needed)), engine=version.group(1) if version else "", install=f"go get {name}" if name else "")


def cargo(text: str) -> dict:
    data = tomllib.loads(text)
    package = data.get("package") or {}
    name = package.get("name") or ""
    library = (data.get("lib") or {}).get("name") or name.replace("-", "_")
    return _filled(
        "rust", pkg_name=name, bin=[b["name"] for b in data.get("bin") or [] if "name" in b], public_names=[library] if library else [], runtime=list(data.get("dependencies") or {}),
        engine=str(package.get("edition") or ""), monorepo="workspace" in data, install=f"cargo add {name}" if name else "",
    )


READERS: dict[str, Callable[[str], dict]] = {
    "package.json": package_json, "pyproject.toml": pyproject, "setup.py": setup_py, "setup.cfg": setup_cfg, "go.mod": go_mod, "cargo.toml": cargo,
}
# The manifest to expect of a language.
BY_LANGUAGE = {"javascript": "package.json", "typescript": "package.json", "python": "pyproject.toml", "go": "go.mod", "rust": "cargo.toml"}


def manifest(path: str | None, language: str | None, text: str | None) -> dict:
    """The manifest by its file name, else by language; kind "none" with the reason if it can't be read."""
    name = (path or "").rpartition("/")[2].lower()
    reader = READERS.get(name) or READERS.get(BY_LANGUAGE.get((language or "").lower(), ""))
    if reader is None or not text:
        return {**EMPTY, "errors": ["no reader" if text else "empty"]}
    try:
        return reader(text)
    except Exception as error:  # noqa: BLE001 - any broken file gives the empty shape
        return {**EMPTY, "errors": [f"{name or language}: {type(error).__name__}"]}


@F.pandas_udf(SCHEMA)
def parsed_manifest(path: pd.Series, language: pd.Series, text: pd.Series) -> pd.DataFrame:
    """``manifest`` as a struct, one batch at a time."""
    return pd.DataFrame([manifest(*x) for x in zip(path, language, text)], columns=list(EMPTY))
