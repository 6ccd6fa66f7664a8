"""Trains models/garble.json: python -m tapeloom.llm.train_garble /root/testdata/sf0.1

Character bigram counts of right text: whole documents and pages, at most
SAMPLE of each.  Runs that the model of the first round finds costly are left
out of the second, so garbled pages do not teach it.
"""

from __future__ import annotations

import json
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from tapeloom.llm.garble import _SIGNS, Costs, _layers

SAMPLE = 20_000
#: A run as frequent as this among the pages is right: wrong decodings are many and each is rare.
OFTEN = 0.01
# Right words with letters and signs that the sample holds seldom.
GOOD = "".join(map(chr, range(32, 127))) + "\n\t\xa0" + "".join(map(chr, range(0x410, 0x450))) + "ёЁäöüÄÖÜß«»„“”‘’—–…№©·•°§×"
RARE = "Dvořák Čapek Škoda Plzeň Brno Łódź Gdańsk Kraków Wałęsa Žižka Führer Weiß Göring Müller Größe Österreich Ärzte Übung Süß Fußball Châlons Besançon café Curaçao señor Ångström Malmö København smørrebrød naïve façade Orléans Györ Székesfehérvár Erdély București Iași Ploiești Тульчинъ п’ять Київ Чернігів Їжак Ґанок Беларусь Ўсход 75 °C 15° 30′ ± × ÷ ½ ¼ § 12 ¶ € 100 £ 5 ™ ® † ‡ • · … “цитата” „Zitat“ ‘слово’ ’тис 1941–1945 № 5 µm Ω Δ α β → ← ≈ ≤ ≥ ² ³".split()


def counts(texts: list[str], chars: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(chars) + 1,) * 2)
    for t in texts:
        ids = np.array([chars.get(c, 0) for c in f" {t} "])
        np.add.at(out, (ids[:-1], ids[1:]), 1)
    return out


def signs_of_utf8(run: str) -> bool:
    """Whether signs in a run read strictly as UTF-8: such a run is garbled, however often it stands."""
    return any(_layers(m.group(), True) for m in _SIGNS.finditer(run))


def main(folder: str) -> None:
    read = lambda t, c: [x for x in pq.read_table(f"{folder}/{t}.parquet", columns=[c])[c].to_pylist()[:SAMPLE] if x]
    htmls = read("rkka", "html")
    runs = [re.sub(r"[ \t\r]+", " ", r) for p in htmls for r in re.findall(r"[^<>]+", p) if r.strip()]
    texts = read("documents", "text")
    texts += [t.upper() for t in texts[::25]]
    runs = [r for r in runs if r.isascii() or not signs_of_utf8(r)]
    often, pages = Counter(runs), len(htmls)
    chars = "".join(sorted({c for c in GOOD + "".join(RARE)}))
    of = {c: i + 1 for i, c in enumerate(chars)}
    costs = None
    for _ in range(3):
        right = [r for r in runs if set(r) <= of.keys() and (r.isascii() or often[r] >= OFTEN * pages or (costs and costs.total(r) / (len(r) + 1) < 4.3))]
        table = counts(texts + right + RARE * 2, of)
        costs = Costs(chars, table)
        print(len(right), "of", len(runs))
    rows, cols = np.nonzero(table)
    model = {"chars": chars, "rows": rows.tolist(), "cols": cols.tolist(), "counts": table[rows, cols].astype(int).tolist()}
    Path(__file__).with_name("models").joinpath("garble.json").write_text(json.dumps(model, ensure_ascii=False, separators=(",", ":")))


if __name__ == "__main__":
    main(sys.argv[1])
