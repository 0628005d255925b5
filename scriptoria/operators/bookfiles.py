"""Parts of DOCX and EPUB files, written by an XML writer from short descriptions of their trees.

An issue is a dictionary: slug, year, title, subtitle (lines) and documents (title, header, body, footer: lines).
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile

# Namespaces and media types of the two formats.
WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
OPF, DC, OPS = "http://www.idpf.org/2007/opf", "http://purl.org/dc/elements/1.1/", "http://www.idpf.org/2007/ops"
XHTML, OCF = "http://www.w3.org/1999/xhtml", "urn:oasis:names:tc:opendocument:xmlns:container"
WORD_TYPE = "application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"
RELS_TYPE = "application/vnd.openxmlformats-package.relationships+xml"
XHTML_TYPE, OPF_TYPE, EPUB_TYPE = "application/xhtml+xml", "application/oebps-package+xml", "application/epub+zip"
XML_SPACE = "{http://www.w3.org/XML/1998/namespace}space"

#: Characters that XML 1.0 has no form for.
_NOT_XML = re.compile("[^\t\n\r -퟿-�\U00010000-\U0010ffff]")


def clean(text: str | None) -> str:
    return _NOT_XML.sub("", text or "")


def tree(space: str, tag: str, *inside, **attributes) -> ET.Element:
    """An element with its attributes (``_`` stands for ``-``), texts and children."""
    node = ET.Element(f"{{{space}}}{tag}", {k.replace("_", "-"): v for k, v in attributes.items()})
    for x in inside:
        if isinstance(x, str):
            node.text = x
        else:
            node.append(x)
    return node


def written(root: ET.Element, space: str) -> bytes:
    """The tree as a file; elements of ``space`` have no prefix, but for Word's, which is usual."""
    for prefix, known in (("", space), ("w", WORD), ("dc", DC), ("epub", OPS)):
        if prefix or known != WORD:
            ET.register_namespace(prefix, known)
    return ET.tostring(root, encoding="utf-8", xml_declaration=True)


def zipped(parts: list[tuple[str, bytes]], stored: tuple[str, ...] = ()) -> bytes:
    """A package; equal parts give equal bytes, as no time is kept."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, part in parts:
            z.writestr(zipfile.ZipInfo(name), part, zipfile.ZIP_STORED if name in stored else zipfile.ZIP_DEFLATED)
    return out.getvalue()


def docx(issue: dict) -> bytes:
    """One paragraph a line; the issue's and the documents' titles are bold."""

    def paragraph(line: str, bold: bool = False) -> ET.Element:
        t = tree(WORD, "t", clean(line))
        t.set(XML_SPACE, "preserve")
        return tree(WORD, "p", tree(WORD, "r", *([tree(WORD, "rPr", tree(WORD, "b"))] if bold else []), t))

    lines = [(issue["title"], True), *((x, False) for x in issue["subtitle"])]
    for d in issue["documents"]:
        lines += [(d["title"], True), *((x, False) for part in ("header", "body", "footer") for x in d[part] or ())]
    body = tree(WORD, "body", *(paragraph(*x) for x in lines), tree(WORD, "sectPr"))
    types = tree(f"{PACKAGE}/content-types", "Types",
                 tree(f"{PACKAGE}/content-types", "Override", PartName="/word/document.xml", ContentType=WORD_TYPE),
                 tree(f"{PACKAGE}/content-types", "Default", Extension="xml", ContentType="application/xml"),
                 tree(f"{PACKAGE}/content-types", "Default", Extension="rels", ContentType=RELS_TYPE))
    links = tree(f"{PACKAGE}/relationships", "Relationships", tree(f"{PACKAGE}/relationships", "Relationship", Id="main", Type=f"{OFFICE}/officeDocument", Target="word/document.xml"))
    return zipped([
        ("[Content_Types].xml", written(types, f"{PACKAGE}/content-types")), ("_rels/.rels", written(links, f"{PACKAGE}/relationships")),
        ("word/document.xml", written(tree(WORD, "document", body), WORD)),
    ])


def epub(issue: dict, modified: str) -> bytes:
    """One text part with a section a document, and a contents list that leads to each of them."""
    title, documents = clean(issue["title"]), issue["documents"]
    name = f"urn:x-issue:{issue['year']}:{issue['slug']}"

    def page(*inside: ET.Element) -> bytes:
        return written(tree(XHTML, "html", tree(XHTML, "head", tree(XHTML, "title", title)), tree(XHTML, "body", *inside), lang="ru"), XHTML)

    def lines(values: list[str] | None, **attributes) -> list[ET.Element]:
        return [tree(XHTML, "p", clean(x), **attributes) for x in values or ()]

    sections = [
        tree(XHTML, "section", tree(XHTML, "h2", clean(d["title"])), *lines(d["header"], **{"class": "header"}), *lines(d["body"]), *lines(d["footer"], **{"class": "footer"}), id=f"d{k}")
        for k, d in enumerate(documents, 1)
    ]
    entries = [tree(XHTML, "li", tree(XHTML, "a", clean(d["title"]), href=f"text.xhtml#d{k}")) for k, d in enumerate(documents, 1)]
    contents = tree(XHTML, "nav", tree(XHTML, "ol", *(entries or [tree(XHTML, "li", tree(XHTML, "a", title, href="text.xhtml"))])))
    contents.set(f"{{{OPS}}}type", "toc")
    about = tree(OPF, "metadata", tree(DC, "language", "ru"), tree(DC, "title", title), tree(DC, "identifier", name, id="issue"), tree(OPF, "meta", modified, property="dcterms:modified"))
    files = tree(OPF, "manifest", tree(OPF, "item", id="body", href="text.xhtml", media_type=XHTML_TYPE), tree(OPF, "item", id="contents", href="nav.xhtml", media_type=XHTML_TYPE, properties="nav"))
    order = tree(OPF, "spine", tree(OPF, "itemref", idref="body"))
    root = tree(OCF, "container", tree(OCF, "rootfiles", tree(OCF, "rootfile", full_path="OEBPS/content.opf", media_type=OPF_TYPE)), version="1.0")
    return zipped([
        ("mimetype", EPUB_TYPE.encode()), ("META-INF/container.xml", written(root, OCF)),
        ("OEBPS/text.xhtml", page(tree(XHTML, "h1", title), *lines(issue["subtitle"], **{"class": "subtitle"}), *sections)), ("OEBPS/nav.xhtml", page(contents)),
        ("OEBPS/content.opf", written(tree(OPF, "package", about, files, order, version="3.0", unique_identifier="issue"), OPF)),
    ], stored=("mimetype",))
