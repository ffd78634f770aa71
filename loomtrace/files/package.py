"""Parts of a ZIP package of XML files, by name, with the targets of their relations."""

from __future__ import annotations

import io
import posixpath
import zipfile
from xml.etree import ElementTree
from xml.etree.ElementTree import Element


def bare(tag: str) -> str:
    """A tag or attribute without its namespace."""
    return tag.rsplit("}", 1)[-1]


def children(element: Element | None, *path: str) -> list[Element]:
    """The elements that a path of bare tags leads to."""
    found = [] if element is None else [element]
    for tag in path:
        found = [c for e in found for c in e if bare(c.tag) == tag]
    return found


def child(element: Element | None, *path: str) -> Element | None:
    return next(iter(children(element, *path)), None)


def inside(element: Element | None, *tags: str) -> list[Element]:
    """All elements below one with one of the bare tags, in order."""
    return [] if element is None else [e for e in element.iter() if bare(e.tag) in tags and e is not element]


def attribute(element: Element | None, name: str, default: str | None = None) -> str | None:
    """An attribute by its bare name."""
    if element is None:
        return default
    if name in element.attrib:
        return element.attrib[name]
    return next((v for k, v in element.attrib.items() if bare(k) == name), default)


def value(element: Element | None, *path: str, name: str = "val") -> str | None:
    return attribute(child(element, *path), name)


def is_on(element: Element | None, *path: str) -> bool | None:
    """Whether a toggle is on: it is where it stands without a value; null where it does not stand."""
    found = child(element, *path)
    return None if found is None else attribute(found, "val", "1") not in ("0", "false", "off")


def text_of(element: Element | None, *tags: str) -> str:
    return "".join(e.text or "" for e in inside(element, *tags))


class Package:
    def __init__(self, data: bytes):
        self.archive = zipfile.ZipFile(io.BytesIO(data))
        self.names = set(self.archive.namelist())

    def read(self, name: str) -> bytes:
        return self.archive.read(name)

    def xml(self, name: str) -> Element | None:
        return ElementTree.fromstring(self.read(name)) if name in self.names else None

    def relations(self, part: str) -> dict[str, tuple[str, str]]:
        """(type, target) by the id of each relation of a part; targets inside are names of parts."""
        folder, name = posixpath.split(part)
        root = self.xml(f"{folder}/_rels/{name}.rels" if folder else f"_rels/{name}.rels")
        found = {}
        for r in children(root, "Relationship"):
            target = r.attrib["Target"]
            if r.attrib.get("TargetMode") != "External":
                target = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
            found[r.attrib["Id"]] = (r.attrib["Type"].rsplit("/", 1)[-1], target)
        return found

    def related(self, part: str, kind: str) -> list[str]:
        """Targets of the relations of a kind, in order."""
        return [t for k, t in self.relations(part).values() if k == kind]
