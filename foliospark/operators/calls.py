"""What runs inside Python workers: calls to the user's function, with errors as values."""

from __future__ import annotations

import json
import time
import uuid
from collections import deque
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

# Characters of texts that a batch of a task's output holds before it is handed on.
BATCH_CHARS = 1 << 20


def attempt(call, attempts: int, wait):
    """``(value, None)`` of the first call that works, or ``(None, error)``."""
    error = ""
    for n in range(1, max(1, attempts) + 1):
        try:
            return call(), None
        except Exception as exc:
            error = str(exc) or type(exc).__name__
        if n < attempts:
            time.sleep(wait(n))
    return None, error


class ServiceDown(RuntimeError):
    """So many texts in a row whose calls raised that a task gives up, and its run with it."""


@dataclass(frozen=True)
class Calling:
    """How the user's function is called: attempts for each text, growth of the wait between them,
    texts in one call, calls of one task at the same time, and after how many texts in a row whose
    calls raised a task ends its run with an error (never, if not given)."""

    attempts: int
    backoff: float
    texts_per_call: int = 1
    in_flight: int = 1
    stop_after: int | None = None


class Caller:
    """Calls the user's function for one task; errors are values.

    What becomes of a text depends on that text and its call alone, not on the texts before it.
    """

    def __init__(self, fn, prompt: str, calling: Calling):
        self.fn, self.prompt, self.calling, self.down = fn, prompt, calling, 0

    def answers(self, texts: list) -> list:
        """``(response, error)`` per text; blank texts are not sent and get ``(None, None)``."""
        results = [(None, None)] * len(texts)
        sent = [i for i, t in enumerate(texts) if t and t.strip()]
        size = max(1, self.calling.texts_per_call)
        parts = [sent[start : start + size] for start in range(0, len(sent), size)]
        for part, found in zip(parts, self._in_order([[texts[i] for i in part] for part in parts])):
            for i, (response, error, asked) in zip(part, found):
                results[i] = response, error
                self._watch(asked, error)
        return results

    def _in_order(self, parts: list):
        """The results of each part, in order; up to ``in_flight`` calls overlap."""
        if self.calling.in_flight <= 1:
            yield from map(self._part, parts)
            return
        waiting: deque = deque()
        with ThreadPoolExecutor(self.calling.in_flight) as pool:
            try:
                for part in parts:
                    if len(waiting) == self.calling.in_flight:
                        yield waiting.popleft().result()
                    waiting.append(pool.submit(self._part, part))
                while waiting:
                    yield waiting.popleft().result()
            finally:
                for call in waiting:
                    call.cancel()

    def _watch(self, asked: bool, error: str | None) -> None:
        self.down = 0 if asked else self.down + 1
        if self.calling.stop_after and self.down >= self.calling.stop_after:
            raise ServiceDown(f"{self.down} texts in a row failed, the last one with: {error}")

    def _ask(self, texts: list) -> list:
        answers = list(self.fn(texts, self.prompt))
        if len(answers) != len(texts):
            raise ValueError(f"{len(answers)} answers to {len(texts)} texts")
        return answers

    def _part(self, texts: list) -> list:
        """``(response, error, whether the service answered at all)`` for each text of one call. A
        call that fails is halved, so a bad text is found in a few calls and cannot fail its neighbours; a
        text alone gets all its attempts."""
        if len(texts) == 1:
            return [self._single(texts[0])]
        answers, _ = attempt(lambda: self._ask(texts), 1, None)
        if answers is None:
            half = len(texts) // 2
            return self._part(texts[:half]) + self._part(texts[half:])
        return [
            (a, None, True) if isinstance(a, str) else self._single(t) for a, t in zip(answers, texts)
        ]

    def _single(self, text: str) -> tuple:
        answered = False

        def call():
            nonlocal answered
            answer = self._ask([text])[0]
            answered = True  # the service is up, whatever it says of this text
            if isinstance(answer, Exception):
                raise answer
            if not isinstance(answer, str):
                raise ValueError("no answer")
            return answer

        pair = attempt(call, self.calling.attempts, lambda n: self.calling.backoff**n)
        return (*pair, answered)


def slices(sizes):
    """Start and length of runs of rows of which each holds ``BATCH_CHARS`` characters or one row more."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= BATCH_CHARS:
            yield start, i + 1 - start
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes) - start


def answer_column(fn, prompt: str, column: str, calling: Calling):
    """``mapInArrow`` function that adds ``response`` and ``error`` for a text column. Python holds the texts
    and answers of one slice at a time, however many rows a batch has."""
    import pyarrow as pa
    from pyarrow import compute as pc

    def run(batches):
        caller = Caller(fn, prompt, calling)
        for whole in batches:
            for start, n in slices(pc.fill_null(pc.binary_length(whole.column(column)), 0).to_pylist()):
                batch = whole.slice(start, n)
                pairs = caller.answers(batch.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array([p[0] for p in pairs], pa.string()),
                        pa.array([p[1] for p in pairs], pa.string()),
                    ],
                    [*batch.schema.names, "response", "error"],
                )

    return run


def answer_lists(fn, prompt: str, column: str, calling: Calling):
    """``mapInArrow`` function that adds ``answers`` for a column of text arrays, a slice at a time."""
    import pyarrow as pa
    from pyarrow import compute as pc

    kind = pa.list_(pa.struct([("response", pa.string()), ("error", pa.string())]))

    def sizes(column) -> list[int]:
        """Bytes of the texts of each row."""
        import numpy as np

        out = np.zeros(len(column), np.int64)
        lengths = pc.fill_null(pc.binary_length(pc.list_flatten(column)), 0)
        np.add.at(out, pc.list_parent_indices(column).to_numpy(), lengths.to_numpy(zero_copy_only=False))
        return out.tolist()

    def run(batches):
        caller = Caller(fn, prompt, calling)
        for whole in batches:
            for start, n in slices(sizes(whole.column(column))):
                batch = whole.slice(start, n)
                lists = batch.column(column).to_pylist()
                flat = [t for texts in lists for t in texts or ()]
                pairs = iter(caller.answers(flat))
                answers = [
                    None
                    if texts is None
                    else [dict(zip(("response", "error"), next(pairs))) for _ in texts]
                    for texts in lists
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(answers, kind)], [*batch.schema.names, "answers"]
                )

    return run


def locate(path: str):
    """Filesystem, path inside it, and what to put before an inner path to get a full one.

    Paths are plain, not percent-encoded; without a scheme they are local.
    """
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path, ""
    scheme, rest = path.split("://", 1)
    authority, _, inner = rest.partition("/")
    root = f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority}/"
    filesystem, base = fs.FileSystem.from_uri(root)
    base = base.rstrip("/")
    return filesystem, f"{base}/{inner}", f"{scheme}://{authority}" if not base else f"{scheme}://"


def list_folders():
    """``mapInArrow`` function that replaces folders by what lies right in them; files pass."""
    import pyarrow as pa
    from pyarrow import fs

    schema = pa.schema(
        [("path", pa.string()), ("folder", pa.bool_()), ("micros", pa.int64()), ("length", pa.int64())]
    )

    def run(batches):
        for batch in batches:
            files = batch.filter(pa.compute.invert(batch.column("folder")))
            yield pa.RecordBatch.from_arrays(files.columns, schema=schema)
            for row in batch.filter(batch.column("folder")).to_pylist():
                filesystem, inner, prefix = locate(row["path"])
                found = filesystem.get_file_info(fs.FileSelector(inner))
                for start in range(0, len(found), 10_000):
                    part = found[start : start + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([prefix + i.path for i in part], pa.string()),
                            pa.array([i.type == fs.FileType.Directory for i in part], pa.bool_()),
                            pa.array([(i.mtime_ns or 0) // 1000 for i in part], pa.int64()),
                            pa.array([i.size or 0 for i in part], pa.int64()),
                        ],
                        schema=schema,
                    )

    return run


def open_texts(columns: dict[str, str]):
    """``mapInArrow`` function that adds the text behind each path column, without byte order
    mark; no path, a lost file or one that is not UTF-8 gives NULL. One file at a time."""
    import pyarrow as pa

    def text(path: str | None) -> str | None:
        if path is None:
            return None
        filesystem, inner, _ = locate(path)
        try:
            with filesystem.open_input_stream(inner) as stream:
                return stream.read().decode("utf-8-sig")
        except (OSError, UnicodeDecodeError):
            return None

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [
                    pa.array([text(p) for p in part.column(c).to_pylist()], pa.string()) for c in columns
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *texts], [*part.schema.names, *columns.values()]
                )

    return run


def open_files():
    """``mapInArrow`` function over (path): ``path, bytes`` of each file that is not empty. A lost file is an error."""
    import pyarrow as pa

    def run(batches):
        paths, found, held = [], [], 0

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(found, pa.binary())], ["path", "bytes"]
            )

        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, inner, _ = locate(path)
                with filesystem.open_input_stream(inner) as stream:
                    content = stream.read()
                if content:
                    paths.append(path)
                    found.append(content)
                    held += len(content)
                if held >= BATCH_CHARS:
                    yield made()
                    paths, found, held = [], [], 0
        if paths:
            yield made()

    return run


def delete_files():
    """``foreachPartition`` function over ``path`` that deletes the files; one that is gone already does no harm."""

    def run(rows):
        for row in rows:
            filesystem, inner, _ = locate(row["path"])
            try:
                filesystem.delete_file(inner)
            except FileNotFoundError:
                pass

    return run


def read_ranges(part_bytes: int):
    """``mapInArrow`` function over (key, path, number): the characters that begin in that part of the
    file, without byte order mark. NULL where the file is gone or the part is not UTF-8."""
    import pyarrow as pa

    def follows(byte: int) -> bool:  # not the first byte of a character
        return byte & 0xC0 == 0x80

    def piece(file, number: int) -> str | None:
        try:
            file.seek(number * part_bytes)
            raw = file.read(part_bytes + 3)
            start, end = 0, min(part_bytes, len(raw))
            while number and start < min(3, end) and follows(raw[start]):
                start += 1
            while end < len(raw) and follows(raw[end]):
                end += 1
            return raw[start:end].decode("utf-8" if number else "utf-8-sig")
        except (OSError, UnicodeDecodeError):
            return None

    def opened(path: str):
        filesystem, inner, _ = locate(path)
        try:
            return filesystem.open_input_file(inner)
        except OSError:
            return None

    def run(batches):
        last, file = None, None
        for batch in batches:
            start, texts, held = 0, [], 0
            for i, (path, number) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if path != last:
                    if file is not None:
                        file.close()
                    last, file = path, opened(path)
                texts.append(None if file is None else piece(file, number))
                held += len(texts[-1] or "")
                if held >= BATCH_CHARS or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(start, len(texts)),
                            batch.column(2).slice(start, len(texts)),
                            pa.array(texts, pa.string()),
                        ],
                        [batch.schema.names[0], "number", "piece"],
                    )
                    start, texts, held = i + 1, [], 0
        if file is not None:
            file.close()

    return run


def extract_documents(fn, attempts: int, wait_seconds: float, from_column: bool):
    """``mapInArrow`` function over (key, path, content, ...): the user's extractor per document.

    Columns after the content (the path, without one) are passed on.

    Files are opened here, one at a time, so only the documents asked for are ever read.
    """
    import pyarrow as pa

    def read(path: str) -> bytes:
        filesystem, inner, _ = locate(path)
        with filesystem.open_input_stream(inner) as stream:
            return stream.read()

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            paths = batch.column(1).to_pylist()
            contents = batch.column(2).to_pylist() if from_column else [None] * len(paths)
            kept = range(3 if from_column else 2, batch.num_columns)
            for i, path in enumerate(paths):

                def call():
                    content = contents[i] if from_column else read(path)
                    layout, markdown = fn(path, content)
                    if layout is not None and not isinstance(layout, str):
                        layout = json.dumps(layout, ensure_ascii=False)
                    return layout, markdown

                value, error = attempt(call, attempts, lambda n: wait_seconds)
                layout, markdown = value or (None, None)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(i, 1),
                        pa.array([layout], pa.string()),
                        pa.array([markdown], pa.string()),
                        pa.array([error is None]),
                        pa.array([error or ""], pa.string()),
                        *[batch.column(c).slice(i, 1) for c in kept],
                    ],
                    [
                        *(batch.schema.names[0], "layout_json", "markdown", "success", "error"),
                        *[batch.schema.names[c] for c in kept],
                    ],
                )

    return run


def write_files(folder: str, bom: bool):
    """``foreachPartition`` function that writes each row's ``content`` under its ``out_name``."""

    def run(rows):
        filesystem, root, _ = locate(folder)
        last = None
        for row in rows:
            target = f"{root}/{row['out_name']}"
            parent, name = target.rsplit("/", 1)
            if parent != last:
                filesystem.create_dir(parent, recursive=True)
                last = parent
            part = f"{parent}/.{name}.{uuid.uuid4().hex}"
            with filesystem.open_output_stream(part) as stream:
                stream.write((row["content"] or "").encode("utf-8-sig" if bom else "utf-8"))
            filesystem.move(part, target)

    return run
