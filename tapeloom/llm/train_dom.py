"""Trains models/dom.json: python -m tapeloom.llm.train_dom /root/testdata/sf0.1

Pages are labelled by a written teacher that knows how pages of these sites
are laid out (``teach``); at most SAMPLE pages teach, a fifth of them is held
out.  Boosted trees with second-order leaf values are grown level by level on
histograms of the binned features.
"""

from __future__ import annotations

import json
import sys
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from tapeloom.llm import dom

SAMPLE, ROUNDS, DEPTH, RATE, LEAST = 6_000, 90, 5, 0.25, 1.0
_SERVER = ("fatal error", "call to undefined", "страница не найдена", "not found", "please enable javascript", "bad gateway", "unavailable")


def teach(title: str, root: dom.Node, leaves: list[dom.Leaf]) -> list[bool] | None:
    """Body or not for each leaf; None where the teacher does not know."""
    no = [False] * len(leaves)
    whole = " ".join(x.text for x in leaves).lower()
    if len(whole) < 250 and any(s in whole for s in _SERVER):
        return no
    own = dom.re.sub(r"\s*(?:[—|·«»]|::|\s-\s)\s*[\w.\-]+\.\w+\s*\Z", "", title)
    key = dom.key_of(own)
    at = [i for i, x in enumerate(leaves) if key and x.key == key and x.sited * 2 <= x.chars]
    if not at:
        at = [i for i, x in enumerate(leaves) if x.node.up.tag in ("h1", "h2", "h3") and not x.sited and not dom.is_furniture(x.text)][:1]
    if not at:
        return None
    head = at[0]
    home = dom.home_of(leaves[head])
    out = list(no)
    flat = home.up is None or home.tag in ("tr", "table")
    for i in range(head, len(leaves)):
        x = leaves[i]
        if not flat:
            m = x.node
            while m is not None and m is not home:
                m = m.up
            if m is None:
                if i > head:
                    break
                continue
        furn = dom.is_furniture(x.text)
        site = x.sited * 2 > x.chars
        teaser = furn and x.sited > 0 or site
        if i > head and flat and (x.before == "hr" or leaves[i - 1].ahead == "hr" or (furn or site) and not (furn and x.sited > 0)):
            break
        if teaser or furn and (x.chars < 40 or "cookie" in x.text.lower()):
            continue
        out[i] = True
    return out


def grow(x: np.ndarray, y: np.ndarray) -> dict:
    """Boosted trees on binned features (values below 128)."""
    n, f = x.shape
    bins = 128
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, base)
    columns = np.arange(f) * bins
    flat = x.astype(np.int64) + columns
    out: dict = {"depth": DEPTH, "base": base, "feature": [], "cut": [], "value": []}
    for r in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, bins, int)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            k = 2**level
            local = at - (k - 1)
            index = (local[:, None] * (f * bins) + flat).ravel()
            gs = np.bincount(index, np.repeat(g, f), k * f * bins).reshape(k, f, bins)
            hs = np.bincount(index, np.repeat(h, f), k * f * bins).reshape(k, f, bins)
            gl, hl = gs.cumsum(2), hs.cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + LEAST) + (gt - gl) ** 2 / (ht - hl + LEAST) - gt**2 / (ht + LEAST)
            best = gain.reshape(k, -1).argmax(1)
            good = gain.reshape(k, -1).max(1) > 1e-3
            feature[k - 1 : 2 * k - 1], cut[k - 1 : 2 * k - 1] = np.where(good, best // bins, 0), np.where(good, best % bins, bins)
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaf = at - (2**DEPTH - 1)
        value = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + LEAST)
        margin += value[leaf]
        out["feature"].append(feature.tolist())
        out["cut"].append(cut.tolist())
        out["value"].append([round(float(v), 4) for v in value])
        if r % 30 == 29:
            print("round", r + 1, "wrong", int(((margin > 0) != y).sum()), "of", n)
    return out


def main(folder: str) -> None:
    pages = [h for h in pq.read_table(f"{folder}/rkka.parquet", columns=["html"])["html"].to_pylist() if h and h.strip()]
    rng = np.random.default_rng(3)
    pages = [pages[i] for i in rng.permutation(len(pages))[:SAMPLE]]
    held = len(pages) // 5
    xs, ys, unknown = [], [], 0
    for h in pages[held:]:
        title, root, leaves = dom.parse(h)
        if not leaves:
            continue
        x, nodes = dom.features(title, root, leaves)
        y = teach(title, root, leaves)
        if y is None:
            unknown += 1
            continue
        inside = {id(leaf): v for leaf, v in zip(leaves, y, strict=True)}
        share: dict[int, list[int]] = {}
        for m in reversed(nodes):
            got = share.setdefault(id(m), [0, 0])
            if m.leaf:
                got[0], got[1] = m.leaf.chars * inside[id(m.leaf)], m.leaf.chars
            if m.up is not None:
                up = share.setdefault(id(m.up), [0, 0])
                up[0] += got[0]
                up[1] += got[1]
        xs.append(x)
        ys.append([share[id(m)][0] * 2 > share[id(m)][1] for m in nodes])
    x, y = dom.binned([r for x in xs for r in x]), np.concatenate(ys).astype(float)
    print(len(pages), "pages,", len(x), "nodes, not known:", unknown)
    model = grow(x, y)
    Path(__file__).with_name("models").joinpath("dom.json").write_text(json.dumps(model, separators=(",", ":")))
    dom.Trees.load.cache_clear()
    trees = dom.Trees.load()
    hit = miss = extra = same = n = 0
    for h in pages[:held]:
        title, root, leaves = dom.parse(h)
        dom.nodes_of(root)
        y = teach(title, root, leaves) if leaves else None
        if y is None:
            continue
        want = {leaf.key for leaf, v in zip(leaves, y, strict=True) if v}
        got = {leaf.key for leaf in dom.body_pieces([h], trees)[0]}
        hit, miss, extra = hit + len(want & got), miss + len(want - got), extra + len(got - want)
        same, n = same + (want == got), n + 1
    print(f"held out: {n} pages, {same} exactly as taught; keys found {hit}, missed {miss}, beyond {extra}")


if __name__ == "__main__":
    main(sys.argv[1])
