"""Complete versions of a dataset under one path.

A run claims a number, writes its data into a folder of its own and, when the
data stand, commits them by one small marker file that is written aside and
renamed.  The version with the highest committed number is the current one:
readers see whole versions only, there is no moment without one, and a run
that started earlier but ends later does not replace a newer one.  Everything
lies in ``_versions`` under the path, which Spark does not take for data.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from logstrata.session import age_seconds, delete_folder, get_text, list_folder, put_text

_FOLDER = "_versions"
#: Uncommitted versions so old belong to a run that was killed.
ABANDONED_SECONDS = 7 * 24 * 3600.0


@dataclass(frozen=True)
class Version:
    number: int
    name: str
    path: str


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root.rstrip("/")
        self.folder = f"{self.root}/{_FOLDER}"

    # Names end in a random part, so runs that draw the same number do not meet.
    def _named(self, kind: str) -> list[str]:
        return [n[len(kind) + 1:].removesuffix(".json") for n in list_folder(self._spark, self.folder) if n.startswith(f"{kind}-")]

    def claim(self) -> Version:
        """A number above all that were claimed or committed, and a folder to write to."""
        last = max((int(n.split("-")[0]) for n in self._named("claim") + self._named("marker")), default=0)
        name = f"{last + 1:012d}-{uuid.uuid4().hex[:8]}"
        put_text(self._spark, f"{self.folder}/claim-{name}.json", "{}")
        return Version(last + 1, name, self.data(name))

    def data(self, name: str) -> str:
        """The folder of a version's data."""
        return f"{self.folder}/data-{name}"

    def commit(self, version: Version, at_the_end: bool = False, **facts) -> None:
        """Make ``version`` readable, with some ``facts`` about it.

        ``at_the_end`` gives it the next number instead of the one claimed,
        for a version that goes on from the current one.  The fact ``uses``
        lists versions whose data it needs too.
        """
        if at_the_end and (newest := max((int(n.split("-")[0]) for n in self.committed()), default=0)) >= version.number:
            later = Version(newest + 1, f"{newest + 1:012d}-{uuid.uuid4().hex[:8]}", version.path)
            self._mark(later, facts)
        else:
            self._mark(version, facts)
        delete_folder(self._spark, f"{self.folder}/claim-{version.name}.json")

    def _mark(self, version: Version, facts: dict) -> None:
        marker = {"version": version.number, "path": version.path, "published_at": dt.datetime.now(dt.timezone.utc).isoformat(), **facts}
        put_text(self._spark, f"{self.folder}/marker-{version.name}.json", json.dumps(marker))

    def abort(self, version: Version) -> None:
        """Remove what an unfinished run has written; a committed version stays."""
        if version.name in self.committed():
            return
        delete_folder(self._spark, version.path)
        delete_folder(self._spark, f"{self.folder}/claim-{version.name}.json")

    @contextmanager
    def writing(self) -> Iterator[Version]:
        """A claimed version; removed if the body fails.  The body, or who comes after it, commits it."""
        version = self.claim()
        try:
            yield version
        except BaseException:
            self.abort(version)
            raise

    def committed(self) -> list[str]:
        """Names of committed versions, oldest first."""
        return sorted(self._named("marker"))

    def latest(self) -> dict | None:
        """Facts of the current version; None before the first."""
        while names := self.committed():
            text = get_text(self._spark, f"{self.folder}/marker-{names[-1]}.json")
            if text is not None:  # else it was removed since, so there is a newer one
                return json.loads(text)
        return None

    def prune(self, keep: int = 2, abandoned_seconds: float = ABANDONED_SECONDS) -> None:
        """Remove all but the last ``keep`` committed versions, and what killed runs left behind long ago.

        Versions that are still being written are not touched.
        """
        names = self.committed()
        kept = names[-keep:] if keep else []
        used = {*kept, *self._named("claim")}
        for name in kept:
            facts = json.loads(get_text(self._spark, f"{self.folder}/marker-{name}.json") or "{}")
            used |= {*facts.get("uses", ()), facts.get("path", "").rpartition("data-")[2]}
        for name in names[: len(names) - len(kept)]:
            delete_folder(self._spark, f"{self.folder}/marker-{name}.json")
        last = kept[-1] if kept else None
        for name in self._named("data"):
            if name not in used and last is not None and name < last:  # later ones may have been claimed since
                delete_folder(self._spark, self.data(name))
        for name in self._named("claim"):
            claim = f"{self.folder}/claim-{name}.json"
            if age_seconds(self._spark, claim) > abandoned_seconds:
                delete_folder(self._spark, self.data(name))
                delete_folder(self._spark, claim)


def current_path(spark: SparkSession, path: str) -> str:
    """Where the data of ``path`` lie now: the current version's folder, or ``path`` itself if it has no versions."""
    latest = Versions(spark, path).latest()
    return latest["path"] if latest else path
