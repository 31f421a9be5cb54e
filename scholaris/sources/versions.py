"""Whole versions of a warehouse, made visible by one step.

A version is a folder that is built where nobody looks, with a manifest of the layers that
belong to it: its own, and older ones that it goes on with. Publishing is the creation of
one empty marker, named after the version, as the very last step; readers take the marker
that comes last and follow its manifest. Nothing that is in use is ever renamed, replaced
or deleted, so a run that stops between any two steps leaves readers the version before,
whole, or the new one, whole.
"""

import json
import re

from pyspark.sql import SparkSession

from scholaris.sources.workspace import children, delete_folder, read_text, write_text

_BUILT, _MARKERS, _MANIFEST = "versions", "published", "manifest.json"


def _versions(spark: SparkSession, directory: str, kind: str) -> list[str]:
    return [name for name in children(spark, f"{directory}/{kind}") if re.fullmatch(r"\d{10}-.*", name)]


def current(spark: SparkSession, directory: str) -> str | None:
    """The published version, or None before the first."""
    return max(_versions(spark, directory, _MARKERS), default=None)


def layers(spark: SparkSession, directory: str, version: str | None = None) -> dict[str, str]:
    """Folders of the layers of a version, by default the published one, by name."""
    version = version or current(spark, directory)
    if version is None:
        return {}
    manifest = json.loads(read_text(spark, f"{directory}/{_BUILT}/{version}/{_MANIFEST}"))
    return {layer: f"{directory}/{_BUILT}/{place}" for layer, place in manifest.items()}


def begin(spark: SparkSession, directory: str, name: str) -> str:
    """The name of a new version, after all that were begun; its folder is `folder` of it."""
    used = _versions(spark, directory, _BUILT) + _versions(spark, directory, _MARKERS)
    number = 1 + max((int(version[:10]) for version in used), default=0)
    return f"{number:010d}-{re.sub(r'[^A-Za-z0-9_.-]', '_', name)}"


def folder(directory: str, version: str) -> str:
    return f"{directory}/{_BUILT}/{version}"


def publish(spark: SparkSession, directory: str, version: str, new_layers: tuple[str, ...]) -> None:
    """Make a version the current one; layers that it does not bring stay the ones in use.

    The manifest is written first and the marker last. A version that is not newer than the
    published one is refused: another run was faster, and readers do not go back.
    """
    before = current(spark, directory)
    if before is not None and before >= version:
        raise RuntimeError(f"version {before} is published already, {version} comes too late")
    kept = layers(spark, directory, before) if before else {}
    prefix = f"{directory}/{_BUILT}/"
    manifest = {layer: path.removeprefix(prefix) for layer, path in kept.items()}
    manifest |= {layer: f"{version}/{layer}" for layer in new_layers}
    write_text(spark, f"{folder(directory, version)}/{_MANIFEST}", json.dumps(manifest))
    write_text(spark, f"{directory}/{_MARKERS}/{version}", "")


def retire(spark: SparkSession, directory: str, keep: int = 2) -> list[str]:
    """Delete what no reader needs: versions that were never published and are older than the
    current one, and published ones but the last `keep`. Returns the deleted names.

    Layers that a kept version goes on with stay. A marker goes before its folder does.
    """
    published = _versions(spark, directory, _MARKERS)
    if not published:
        return []
    kept = published[-keep:]
    places = [path for version in kept for path in layers(spark, directory, version).values()]
    held = {place.removeprefix(f"{directory}/{_BUILT}/").split("/")[0] for place in places}
    gone = []
    for version in _versions(spark, directory, _BUILT):
        if version < published[-1] and version not in kept:
            if version in published:
                delete_folder(spark, f"{directory}/{_MARKERS}/{version}")
            if version not in held:
                delete_folder(spark, folder(directory, version))
                gone.append(version)
    return gone
