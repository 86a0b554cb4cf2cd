"""A cuckoo filter over digests, with the stored keys that make its answers exact."""

import hashlib
from collections.abc import Iterator

_SLOTS = 4  # fingerprints of a bucket
_KICKS = 200  # moves after which an insertion gives up and the table doubles
_LOAD = 0.9


class CuckooIndex:
    """Live digests with a value each. Digests are 32 bytes, as of sha256.

    The filter holds a 16-bit fingerprint per digest in one of two buckets. A lookup that finds no
    fingerprint is a sure miss. A hit is verified against the content kept for that bucket, the whole digests,
    so false positives never count. An insertion moves fingerprints between their two buckets to make room;
    when that fails, or the table is nearly full, the table is filled again from the stored keys: with twice the
    buckets if it is over half full, else with fingerprints and buckets drawn anew, because then digests
    that share both are in each other's way and more room would not part them.
    """

    def __init__(self, buckets: int = 1 << 8):
        self._salt = 0
        self._grow_to(buckets, [])

    def _grow_to(self, buckets: int, items: list[tuple[bytes, object]]) -> None:
        """Start afresh with ``buckets`` buckets, or more if the items need them."""
        while True:
            self._mask = buckets - 1
            self._table: list[list[int]] = [[] for _ in range(buckets)]
            self._content: dict[int, dict[bytes, object]] = {}
            self._count = 0
            if all(self._place(digest, value) for digest, value in items):
                return
            if 2 * len(items) > _SLOTS * buckets:
                buckets *= 2
            else:
                self._salt += 1

    def _drawn(self, digest: bytes) -> bytes:
        """The bits that fingerprint and buckets come from; under a later salt they depend on the whole digest."""
        if not self._salt:
            return digest[8:18]
        return hashlib.blake2b(digest, digest_size=10, salt=self._salt.to_bytes(8, "little")).digest()

    def _print(self, digest: bytes) -> int:
        return int.from_bytes(self._drawn(digest)[:2], "little") or 1

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(self._drawn(digest)[2:], "little") & self._mask

    def _other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & self._mask

    def _key(self, digest: bytes) -> int:
        """The content bucket of a digest: the lower of its two table buckets, the same wherever it sits."""
        home = self._home(digest)
        return min(home, self._other(home, self._print(digest)))

    def __len__(self) -> int:
        return self._count

    def _maybe(self, digest: bytes) -> bool:
        fingerprint, home = self._print(digest), self._home(digest)
        return fingerprint in self._table[home] or fingerprint in self._table[self._other(home, fingerprint)]

    def get(self, digest: bytes) -> object | None:
        """The value of a live digest, else None."""
        if not self._maybe(digest):
            return None
        return self._content.get(self._key(digest), {}).get(digest)

    def put(self, digest: bytes, value: object) -> None:
        """Insert a digest, or give a live one a new value."""
        if self._maybe(digest):
            bucket = self._content.get(self._key(digest), {})
            if digest in bucket:
                bucket[digest] = value
                return
        if self._count + 1 > _LOAD * _SLOTS * (self._mask + 1):
            self._grow_to(2 * (self._mask + 1), [*self.items(), (digest, value)])
        elif not self._place(digest, value):
            self._grow_to(self._mask + 1, [*self.items(), (digest, value)])

    def _place(self, digest: bytes, value: object) -> bool:
        fingerprint, bucket = self._print(digest), self._home(digest)
        moved = []
        for kick in range(_KICKS):
            for option in (bucket, self._other(bucket, fingerprint)):
                if len(self._table[option]) < _SLOTS:
                    self._table[option].append(fingerprint)
                    self._content.setdefault(self._key(digest), {})[digest] = value
                    self._count += 1
                    return True
            bucket = self._other(bucket, fingerprint)
            slot = (fingerprint + kick) % _SLOTS
            moved.append((bucket, slot))
            self._table[bucket][slot], fingerprint = fingerprint, self._table[bucket][slot]
        for bucket, slot in reversed(moved):  # as it was before
            self._table[bucket][slot], fingerprint = fingerprint, self._table[bucket][slot]
        return False

    def delete(self, digest: bytes) -> bool:
        """Remove a live digest; False if it was not live, and nothing changes."""
        if self.get(digest) is None:
            return False
        fingerprint, home = self._print(digest), self._home(digest)
        other = self._other(home, fingerprint)
        self._table[home if fingerprint in self._table[home] else other].remove(fingerprint)
        bucket = self._content[self._key(digest)]
        del bucket[digest]
        if not bucket:
            del self._content[self._key(digest)]
        self._count -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        for bucket in self._content.values():
            yield from bucket.items()
