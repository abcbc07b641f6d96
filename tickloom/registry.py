"""Named factories, so that parts are chosen by configuration."""

from __future__ import annotations

from collections.abc import Callable
from importlib import metadata

#: What this release registers and accepts.
API_VERSION = 1


class Registry:
    """Factories by name; a name is given once, and unknown names list what there is.

    A factory states the version it was written for; others than the registry's are refused.  With ``group``, entry
    points of other distributions are loaded when a name is asked for that is not there.
    """

    def __init__(self, kind: str, group: str | None = None, version: int = API_VERSION):
        self.kind, self.group, self.version = kind, group, version
        self._made: dict[str, Callable] = {}

    def register(self, name: str, factory: Callable | None = None, version: int | None = None) -> Callable:
        if factory is None:
            return lambda f: self.register(name, f, version)
        wanted = self.version if version is None else version
        if wanted != self.version:
            raise ValueError(f"{self.kind} {name!r} is of version {wanted}; {self.version} is needed")
        if name in self._made:
            raise ValueError(f"{self.kind} {name!r} is there already")
        self._made[name] = factory
        return factory

    def make(self, name: str, *args, **kwargs):
        if name not in self._made:
            found = {e.name: e for e in metadata.entry_points(group=self.group)} if self.group else {}
            if name not in found:
                raise ValueError(f"unknown {self.kind} {name!r}; there are {', '.join(sorted({*self._made, *found}))}")
            factory = found[name].load()
            self.register(name, factory, getattr(factory, "api_version", None))
        return self._made[name](*args, **kwargs)

    def names(self) -> list[str]:
        return sorted(self._made)
