"""The training step against finite differences of its loss."""

import numpy as np

from tamis.llm import toxicity


def test_the_step_follows_the_gradient():
    rng = np.random.default_rng(4)
    model = toxicity.Model()
    docs = [[f"w{rng.integers(30)}" for _ in range(20)] for _ in range(12)]
    y = np.arange(12) % 2
    model.fit(docs, y, warm=1, epochs=0, rate=0.0)  # lays out words and passages, moves nothing
    for name in ("emb", "out", "bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    weight = np.array([0.7, 1.9])
    some = [model._said[model._cuts[i] : model._cuts[i + 1]] for i in range(len(model._cuts) - 1)]

    def loss() -> float:
        total = 0.0
        for passage, truth in zip(some, y, strict=True):
            bag = np.zeros(toxicity.DIMENSIONS)
            for word in passage:
                own = model._flat[model._ends[word] : model._ends[word + 1]]
                bag += (model.emb[own] * model.scale[own, None]).mean(0) / toxicity.WINDOW
            z = bag @ model.out + model.bias
            total += weight[truth] * (np.log(np.exp(z).sum()) - z[truth])
        return total

    def slope(table: np.ndarray, at: tuple) -> float:
        step, held = 1e-5, table[at]
        table[at] = held + step
        up = loss()
        table[at] = held - step
        down = loss()
        table[at] = held
        return (up - down) / (2 * step)

    used = np.unique(model._flat)[:: max(1, len(np.unique(model._flat)) // 15)]
    places = {"out": [(i, j) for i in range(toxicity.DIMENSIONS) for j in (0, 1)], "bias": [(0,), (1,)], "emb": [(int(b), d) for b in used for d in (0, 5)]}
    want = {name: {at: slope(getattr(model, name), at) for at in ats} for name, ats in places.items()}
    before = {name: getattr(model, name).copy() for name in places}
    rate = 1e-3
    model._step(some, y, weight, rate)
    share = {"emb": 1.0, "out": 1 / (5 * len(y)), "bias": 1 / (10 * len(y))}
    for name, slopes in want.items():
        moved = np.array([(getattr(model, name)[at] - before[name][at]) / (-rate * share[name]) for at in slopes])
        assert np.allclose(moved, list(slopes.values()), rtol=1e-3, atol=1e-6), name
