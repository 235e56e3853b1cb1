"""Outputs that appear whole, or not at all.

A job writes each output into a folder beside its target and puts all of them
in place at the end. Until then the old outputs stand untouched; a job that
fails, on the way or in its last write, leaves them as they were.

Putting in place takes two phases. First a manifest (every move, with the
number of files and bytes) is written into the parent folder of every target;
the publication is decided when the last of these copies, the *decider*,
appears under its name. Then each old output is renamed aside and each new one
renamed to its target, checked against the manifest, and only then the old
ones are deleted. A driver that dies in between leaves manifests behind; the
next publication of any of the targets finds them and goes on where that one
stopped (decider there) or takes it back (no decider).

Renames are one step each where the file system does them so (HDFS, local,
and object stores with a rename); where a store copies file by file, what is
left of a broken copy is moved file by file on resumption. One job at a time
may publish to a target.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from dialogprep.sources.listing import read_small_text, resolve

_MANIFEST = "_publish-"


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")


class _Files:
    """The few file-system calls that a publication makes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def of(self, path: str):
        return resolve(self.spark, path)

    def exists(self, path: str) -> bool:
        fs, p = self.of(path)
        return bool(fs.exists(p))

    def delete(self, path: str) -> None:
        fs, p = self.of(path)
        fs.delete(p, True)

    def rename(self, source: str, target: str) -> None:
        fs, p = self.of(source)
        _rename(fs, p, self.of(target)[1])

    def write(self, path: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        fs, p = self.of(path)
        fs.mkdirs(p.getParent())
        part = self.path(p.getParent(), p.getName() + ".part")
        out = fs.create(part, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if fs.exists(p):
            fs.delete(p, False)
        _rename(fs, part, p)

    def size(self, path: str) -> tuple[int, int]:
        fs, p = self.of(path)
        found = fs.getContentSummary(p)
        return int(found.getFileCount()), int(found.getLength())

    def beside(self, path: str, suffix: str) -> str:
        """A hidden name beside ``path``; Spark's readers skip it."""
        _, p = self.of(path)
        return self.path(p.getParent(), f"_{p.getName()}{suffix}").toString()

    def manifests(self, folder: str) -> list[str]:
        fs, p = self.of(folder)
        return [s.getPath().toString() for s in fs.globStatus(self.path(p, _MANIFEST + "*.json")) or []]

    def leftovers(self, path: str) -> list[str]:
        """Folders of unfinished writes to ``path``."""
        fs, p = self.of(path)
        return [
            s.getPath().toString()
            for s in fs.listStatus(p.getParent()) or []
            if s.getPath().getName().startswith(f"_{p.getName()}.staging-")
        ] if fs.exists(p.getParent()) else []

    def parent(self, path: str) -> str:
        return self.of(path)[1].getParent().toString()

    def merge(self, source: str, target: str) -> None:
        """Move what is left in ``source`` into ``target``, file by file."""
        fs, s = self.of(source)
        root, t = s.toUri().getPath().rstrip("/"), self.of(target)[1]
        files = fs.listFiles(s, True)
        while files.hasNext():
            one = files.next().getPath()
            to = self.path(t, one.toUri().getPath()[len(root) + 1 :])
            fs.mkdirs(to.getParent())
            if fs.exists(to):
                fs.delete(to, False)
            _rename(fs, one, to)
        fs.delete(s, True)


def _finish(files: _Files, manifest: dict) -> None:
    """Make all moves of a decided publication; may run again after a stop."""
    for move in manifest["moves"]:
        staged, target, old = move["staged"], move["target"], move["old"]
        if files.exists(staged):
            if files.exists(target):
                if files.exists(old):
                    files.merge(staged, target)
                else:
                    files.rename(target, old)
            if files.exists(staged):
                files.rename(staged, target)
        if files.size(target) != (move["files"], move["bytes"]):
            raise OSError(f"{target} is not what was written: {files.size(target)}, not {move['files'], move['bytes']}")
    for move in manifest["moves"]:
        files.delete(move["old"])
    for path in manifest["scratch"]:
        files.delete(path)
    for copy in manifest["copies"]:
        files.delete(copy)
    files.delete(manifest["decider"])


def recover(spark: SparkSession, targets: list[str]) -> list[str]:
    """Finish or take back publications to ``targets`` that were broken off.

    Returns what was done, as ``finished <token>`` or ``undone <path>``.
    """
    files, done = _Files(spark), []
    for folder in dict.fromkeys(files.parent(t) for t in targets):
        for path in files.manifests(folder):
            if not files.exists(path):
                continue  # finished along with an earlier one
            manifest = json.loads(read_small_text(spark, path))
            if files.exists(manifest["decider"]):
                _finish(files, manifest)
                done.append(f"finished {manifest['token']}")
            else:
                places = [manifest["decider"], *manifest["copies"]]
                for gone in [m["staged"] for m in manifest["moves"]] + manifest["scratch"]:
                    files.delete(gone)
                for place in places:
                    files.delete(place + ".part")
                    files.delete(place)
                done.append(f"undone {path}")
    for target in targets:
        for path in files.leftovers(target):
            token = path.rsplit(".staging-", 1)[1][:32]
            files.delete(f"{files.parent(target)}/{_MANIFEST}{token}.json.part")
            files.delete(path)
            done.append(f"undone {path}")
    return done


class Publication:
    """``with Publication(spark, {name: target}) as out:`` write to
    ``out.path(name)``; everything is put in place at the end of the block,
    or nothing if it raises. Targets that are None are left out."""

    def __init__(self, spark: SparkSession, targets: dict[str, str | None]):
        self.files = _Files(spark)
        self.spark = spark
        self.targets = {n: t for n, t in targets.items() if t}
        self.token = uuid.uuid4().hex
        self.staged = {n: self.files.beside(t, f".staging-{self.token}") for n, t in self.targets.items()}
        self.scratch_paths: list[str] = []
        self.decided = False

    def path(self, name: str) -> str:
        return self.staged[name]

    def scratch(self, name: str, label: str) -> str:
        """A folder beside the target ``name`` that goes with the publication."""
        path = self.files.beside(self.targets[name], f".staging-{self.token}-{label}")
        self.scratch_paths.append(path)
        return path

    def take(self, name: str, path: str) -> None:
        """Publish ``path`` (in a scratch folder) as the output ``name``."""
        self.staged[name] = path

    def __enter__(self) -> Publication:
        recover(self.spark, list(self.targets.values()))
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()
        elif not self.decided:
            for path in [*self.staged.values(), *self.scratch_paths]:
                self.files.delete(path)

    def commit(self) -> None:
        files, moves = self.files, []
        for name, target in self.targets.items():
            staged = self.staged[name]
            fs, path = files.of(staged)
            fs.mkdirs(path)  # an output without rows is an empty folder
            n, size = files.size(staged)
            old = files.beside(target, f".old-{self.token}")
            moves.append({"name": name, "staged": staged, "target": target, "old": old, "files": n, "bytes": size})
        if not moves:
            return
        places = [f"{folder}/{_MANIFEST}{self.token}.json" for folder in dict.fromkeys(files.parent(t) for t in self.targets.values())]
        manifest = {"token": self.token, "decider": places[0], "copies": places[1:], "moves": moves, "scratch": self.scratch_paths}
        for place in reversed(places):
            self.decided = place == places[0]
            files.write(place, json.dumps(manifest))
        _finish(files, manifest)
