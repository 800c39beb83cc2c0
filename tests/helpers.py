"""Archives built by hand, with every detail chosen by the test."""

import gzip
import json
import zipfile


def page_list(*pages, header='{"format": "json-pages-1.0"}'):
    return "".join(f"{line}\n" for line in [header, *(json.dumps(p) for p in pages)])


def cdx_line(url, filename="rec-0.warc.gz", offset="0", mime="text/html", **fields):
    body = {"url": url, "mime": mime, "status": "200", "length": "9", "offset": offset,
            "filename": filename, **fields}
    return f"key) 20250101000000 {json.dumps(body)}\n"


def http_block(body, *headers, status="HTTP/1.1 200 OK"):
    head = "\r\n".join([status, *(f"{n}: {v}" for n, v in headers)])
    return head.encode("utf-8") + b"\r\n\r\n" + body


def warc_record(block, content_type="application/http; msgtype=response", kind="response"):
    head = (
        f"WARC/1.1\r\nWARC-Type: {kind}\r\nContent-Type: {content_type}\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def warc_file(*records, pack=True):
    """Bytes of a WARC file and the offset of each record."""
    data, offsets = b"", []
    for record in records:
        offsets.append(len(data))
        data += gzip.compress(record) if pack else record
    return data, offsets


def write_archive(path, members, deflate=()):
    with zipfile.ZipFile(path, "w") as archive:
        for name, data in members.items():
            kind = zipfile.ZIP_DEFLATED if name in deflate else zipfile.ZIP_STORED
            archive.writestr(name, data, kind)
    return str(path)
