"""A mailbox as a Spark data source: a partition for each day, a reader that a caller plugs in.

The offline reader lists .eml files in folders named by day. Register with spark.dataSource.register(MailboxSource), then
spark.read.format("mailbox").option("path", ...).option("first", day).option("last", day).load(). With option("headers", "true") bodies and parts aren't read.
"""

from __future__ import annotations

import datetime
import email
import email.policy
import os
import re

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "date_folder string, message_id string, `from` string, `to` string, cc string, subject string, `date` string, body string, raw_size bigint, parts array<struct<kind:string,disposition:string,name:string,size:bigint>>"


def plain_html(text: str) -> str:
    """What `functions.text.strip_html` gives for a column: tags go, named entities become a space."""
    return re.sub(r"&[a-z]+;", " ", re.sub(r"<[^>]+>", "", text))


def read_headers(raw: bytes, day: str) -> tuple:
    """A raw message's headers as a row, without looking at its body."""
    msg = email.message_from_bytes(re.split(rb"\r?\n\r?\n", raw, maxsplit=1)[0] + b"\r\n\r\n", policy=email.policy.default)
    head = lambda name: str(msg[name]) if msg[name] is not None else None
    return day, head("message-id"), head("from"), head("to"), head("cc"), head("subject"), head("date"), None, len(raw), []


def read_message(raw: bytes, day: str) -> tuple:
    """A raw message as a row: decoded headers, text parts joined, and what other parts there are."""
    msg = email.message_from_bytes(raw, policy=email.policy.default)
    texts, parts = [], []
    for part in msg.walk():
        if part.is_multipart():
            continue
        kind, disposition = part.get_content_type(), part.get_content_disposition() or ""
        if kind in ("text/plain", "text/html") and disposition != "attachment":
            try:
                text = part.get_content()
            except (LookupError, ValueError):
                text = (part.get_payload(decode=True) or b"").decode("utf-8", "replace")
            if len((plain_html(text) if kind == "text/html" else text).strip()) > 10:
                texts.append(plain_html(text) if kind == "text/html" else text)
        else:
            parts.append((kind, disposition, part.get_filename() or "", len(part.get_payload(decode=True) or b"")))
    head = lambda name: str(msg[name]) if msg[name] is not None else None
    return day, head("message-id"), head("from"), head("to"), head("cc"), head("subject"), head("date"), "\n".join(texts), len(raw), parts


def folder_reader(path: str, day: str):
    """Raw messages of one day."""
    place = os.path.join(path, day)
    for name in sorted(os.listdir(place)) if os.path.isdir(place) else []:
        if name.endswith(".eml"):
            with open(os.path.join(place, name), "rb") as f:
                yield f.read()


class MailboxSource(DataSource):
    #: Gives the raw messages of a day; another mailbox protocol replaces it.
    fetch = staticmethod(folder_reader)

    @classmethod
    def name(cls):
        return "mailbox"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return MailboxReader(self.options, type(self).fetch)


class MailboxReader(DataSourceReader):
    def __init__(self, options, fetch):
        self.path, self.fetch = options["path"], fetch
        self.row = read_headers if options.get("headers", "false").lower() == "true" else read_message
        self.attempts = int(options.get("attempts", "5"))
        self.first, self.last = (datetime.date.fromisoformat(options[k]) for k in ("first", "last"))
        if self.first > self.last:
            raise ValueError("the range ends before it begins")

    def partitions(self):
        return [InputPartition((self.first + datetime.timedelta(days=i)).isoformat()) for i in range((self.last - self.first).days + 1)]

    def read(self, partition):
        for raw in self._fetched(partition.value):
            yield self.row(raw, partition.value)

    def _fetched(self, day: str):
        """The raw messages of a day; a fetch that fails goes on after the messages that it gave, `attempts` times in all."""
        done = 0
        for attempt in range(1, self.attempts + 1):
            try:
                for i, raw in enumerate(self.fetch(self.path, day)):
                    if i >= done:
                        done += 1
                        yield raw
                return
            except OSError:
                if attempt == self.attempts:
                    raise
