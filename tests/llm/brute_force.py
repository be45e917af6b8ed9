"""Plain versions that several tests compare with."""

import xxhash


def by_definition(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(fps, distance=3):
    """{fingerprint: set of fingerprints reachable}, all pairs compared."""
    fps, out = set(fps), {}
    while fps:
        todo, found = [fps.pop()], set()
        while todo:
            x = todo.pop()
            found.add(x)
            near = {y for y in fps if (x ^ y).bit_count() <= distance}
            fps -= near
            todo += near
        out |= dict.fromkeys(found, found)
    return out
