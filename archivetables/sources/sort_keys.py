"""The keys that capture indexes are sorted by: a URL with its host turned round.

Index writers differ in what they take away from a URL, so a URL has a few keys. They agree on URLs of
plain characters; others (escapes, user names, dot segments) may be rewritten in ways not tried here, and
``is_plain`` tells them apart.
"""

from __future__ import annotations

import re

PARTS = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?")
PLAIN = re.compile(
    r"https?://[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*(:[0-9]+)?(/[A-Za-z0-9._~-]+)*/?(\?[A-Za-z0-9._~=&/-]*)?(#.*)?",
    re.ASCII | re.DOTALL,
)
DOT_SEGMENT = re.compile(r"/\.{1,2}(/|\?|#|$)")
WWW = re.compile(r"^www[0-9]*\.")
# fixed values: what index writers take for session numbers, and the ports that go without saying
SESSION = re.compile(r"(?i)(?<=[?&])(?:jsessionid|phpsessid|sid|cfid|cftoken|aspsessionid[a-z]{8})=[^&]*&?")
DEFAULT_PORTS = {"http": "80", "https": "443"}


def is_plain(url: str) -> bool:
    return PLAIN.fullmatch(url) is not None and not DOT_SEGMENT.search(url)


def sort_key(url: str) -> str:
    """The usual key: lower case, without ``www``, default port, session numbers, closing slash and fragment,
    the query's parts in order."""
    found = PARTS.match(url)
    if found is None:
        return url.replace(" ", "%20")
    scheme, host, path, query = found.groups(default="")
    path = path.lower()
    query = _ordered(_without_sessions(query.lower()))
    path = path.rstrip("/") if len(path) > 1 else "/"
    return f"{_host(scheme, WWW.sub('', host.lower()))}){path or '/'}{query}".replace(" ", "%20")


def sort_keys(url: str) -> set[str]:
    """All keys that a URL may have in an index, the usual one among them."""
    found = PARTS.match(url)
    if found is None:
        return {url.replace(" ", "%20")}
    scheme, host, path, query = found.groups(default="")
    hosts = {_host(scheme, h) for h in (host.lower(), WWW.sub("", host.lower()))}
    paths = {p for q in {path, path.lower()} for p in (q or "/", q.rstrip("/") or "/")}
    queries = {q for each in {query, query.lower()} for q in (each, _without_sessions(each))}
    queries |= {_ordered(q) for q in queries}
    return {f"{h}){p}{q}".replace(" ", "%20") for h in hosts for p in paths for q in queries}


def _host(scheme: str, host: str) -> str:
    name, _, port = host.rpartition("@")[2].partition(":")
    turned = name if re.fullmatch(r"[0-9.]+", name) else ",".join(reversed(name.split(".")))
    return f"{turned}:{port}" if port and port != DEFAULT_PORTS.get(scheme.lower()) else turned


def _without_sessions(query: str) -> str:
    return SESSION.sub("", query).rstrip("?&")


def _ordered(query: str) -> str:
    return query[:1] + "&".join(sorted(query[1:].split("&")))
