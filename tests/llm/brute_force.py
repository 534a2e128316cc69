"""Plain versions that the tests compare with."""

import re

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_ok(kind, m):
    digits = re.sub("[^0-9]", "", m)
    luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else 0, "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}[kind]


def brute_simhash(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def near_brute(texts: dict) -> set:
    """The ids that stay: the least of each component of pairs with a similarity of 0.8 or more."""
    sets = {}
    for k, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids, lead = sorted(sets), {k: k for k in sets}

    def top(k):
        while lead[k] != k:
            k = lead[k]
        return k

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                lo, hi = sorted((top(a), top(b)))
                lead[hi] = lo
    return {k for k in ids if top(k) == k}
