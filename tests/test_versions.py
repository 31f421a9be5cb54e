"""Publishing: whichever step a run stops at, readers see one whole version."""

from pathlib import Path

import pytest

from scholaris.sources import versions

LAYERS = ("staging", "analytics")


def build(spark, root, name, layers=LAYERS):
    version = versions.begin(spark, root, name)
    for layer in layers:
        folder = Path(versions.folder(root, version), layer)
        folder.mkdir(parents=True)
        (folder / "data").write_text(name)
    return version


def seen(spark, root):
    return {layer: Path(folder, "data").read_text() for layer, folder in versions.layers(spark, root).items()}


def test_nothing_is_seen_before_the_first(spark, tmp_path):
    root = str(tmp_path / "w")
    assert versions.current(spark, root) is None and versions.layers(spark, root) == {}
    build(spark, root, "a")
    assert versions.layers(spark, root) == {} and versions.retire(spark, root) == []


def test_a_version_may_go_on_with_older_layers(spark, tmp_path):
    root = str(tmp_path)
    versions.publish(spark, root, build(spark, root, "a"), LAYERS)
    versions.publish(spark, root, build(spark, root, "b", ("staging",)), ("staging",))
    assert seen(spark, root) == {"staging": "b", "analytics": "a"}
    for name in ("c", "d"):
        versions.publish(spark, root, build(spark, root, name, ("staging",)), ("staging",))
    gone = versions.retire(spark, root, keep=1)
    assert [g[11:] for g in gone] == ["b", "c"] and seen(spark, root) == {"staging": "d", "analytics": "a"}


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", range(12))
def test_a_stop_between_any_two_steps(spark, tmp_path, monkeypatch, step):
    """Every write and delete of a run, one after another, is the one that never happens."""
    root = str(tmp_path)
    for name in ("a", "b"):
        versions.publish(spark, root, build(spark, root, name), LAYERS)
    left = [step]

    def counted(act):
        def run(*args):
            if left[0] == 0:
                raise Stopped
            left[0] -= 1
            return act(*args)

        return run

    for name in ("write_text", "delete_folder"):
        monkeypatch.setattr(versions, name, counted(getattr(versions, name)))
    stopped = False
    try:
        for name in ("c", "d"):
            versions.publish(spark, root, build(spark, root, name), LAYERS)
            versions.retire(spark, root)
    except Stopped:
        stopped = True
    found = seen(spark, root)
    assert len(set(found.values())) == 1 and set(found) == set(LAYERS)
    assert found["staging"] == "d" or stopped
    # The next run goes on from there, and clears away what the stopped one left.
    monkeypatch.undo()
    versions.publish(spark, root, build(spark, root, "next"), LAYERS)
    versions.retire(spark, root, keep=1)
    assert seen(spark, root) == dict.fromkeys(LAYERS, "next")
    assert [p.name[11:] for p in Path(root, "versions").iterdir()] == ["next"]


def test_a_slower_run_does_not_turn_readers_back(spark, tmp_path):
    root = str(tmp_path)
    slow, fast = build(spark, root, "slow"), build(spark, root, "fast")
    versions.publish(spark, root, fast, LAYERS)
    with pytest.raises(RuntimeError, match="too late"):
        versions.publish(spark, root, slow, LAYERS)
    assert set(seen(spark, root).values()) == {"fast"}


def test_names_are_made_fit_for_folders(spark, tmp_path):
    assert versions.begin(spark, str(tmp_path), "2026-07-16 /x:y") == "0000000001-2026-07-16__x_y"
