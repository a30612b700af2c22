"""Claims on extract files, so that of several loads at once one loads each file.

A claim is a file that only one load can create. Claims on one extract are numbered, and the highest
one counts. One that is older than `expires` seconds was left by a load that died; the next load that
wants the file makes the claim with the next number, which again only one can. A load that has been
overtaken like this notices before it logs the file. Claims go once the file is in the load log, so a
load that gets a claim has to look into the log again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

from cashline.storage import ages, create_new, escaped, exists, folders_in, remove_folder

EXPIRES = 6 * 3600.0
FOLDER = "_claims"


@dataclass
class Claims:
    """The claims of one load, by file name."""

    spark: SparkSession
    raw_dir: str
    expires: float = EXPIRES

    def __post_init__(self):
        self.held: dict[str, int] = {}

    def _folder(self, file_name: str) -> str:
        return f"{self.raw_dir}/{FOLDER}/{escaped(self.spark, file_name)}"

    def _last(self, file_name: str) -> tuple[int, float]:
        """The highest claim there is and its age; 0 if there is none."""
        found = {int(n): age for n, age in ages(self.spark, self._folder(file_name)).items() if n.isdigit()}
        number = max(found, default=0)
        return number, found.get(number, 0.0)

    def _each(self, do: Callable[[str], object], names: Iterable[str]) -> list:
        """Of thousands of files, each a few calls to the file system."""
        with ThreadPoolExecutor(16) as pool:
            return list(pool.map(do, names))

    def take(self, file_names: Iterable[str]) -> set[str]:
        """Claim what no other load has claimed, and name it."""
        known = set(folders_in(self.spark, f"{self.raw_dir}/{FOLDER}"))

        def claim(name: str) -> tuple[str, int] | None:
            number, age = self._last(name) if escaped(self.spark, name) in known else (0, 0.0)
            free = number == 0 or age > self.expires
            return (name, number + 1) if free and create_new(self.spark, f"{self._folder(name)}/{number + 1}") else None

        taken = dict(c for c in self._each(claim, file_names) if c)
        self.held |= taken
        return set(taken)

    def lost(self) -> list[str]:
        """Files that another load has claimed since, as ours had expired."""
        overtaken = self._each(lambda n: exists(self.spark, f"{self._folder(n)}/{self.held[n] + 1}"), self.held)
        return [name for name, gone in zip(self.held, overtaken) if gone]

    def give_back(self) -> None:
        lost = set(self.lost())
        self._each(lambda name: remove_folder(self.spark, self._folder(name)), [n for n in self.held if n not in lost])
        self.held.clear()
