"""Training steps of the attention model, against Adam written plainly."""

from __future__ import annotations

import numpy as np

from cashcycle.llm.attention import Adam, AttentionOptions, Model, Vocabulary, _add_rows, _places, windows

OPTIONS = AttentionOptions(width=8, key_width=4, context=3, scored=4, groups=4, group_size=5, batch=6)


def lessons():
    draw = np.random.default_rng(3)
    ids = draw.integers(0, 30, 200).astype(np.uint32)
    vocabulary = Vocabulary.fit(np.bincount(ids, minlength=40), OPTIONS)
    x, target, _ = windows(ids, np.array([0, 70, 70, 200]), 39, vocabulary, OPTIONS)
    return Model.start(vocabulary, OPTIONS), x, target


def test_gradients_fill_one_array_that_is_laid_out_as_the_weights():
    model, x, target = lessons()
    loss, grads = model.gradients(x, target)
    out = np.zeros(len(model.flat()), np.float32)
    assert model._gradients(x, target, out) == loss
    assert np.array_equal(out, np.concatenate([grads[k].reshape(-1) for k in sorted(grads)]))
    assert set(grads) == set(model.w) and all(grads[k].shape == model.w[k].shape for k in grads)


def test_training_is_adam():
    model, x, target = lessons()
    plain = model.with_flat(model.flat())
    start = model.flat()
    model.train(x, target, 25, seed=8)
    draw, queue = np.random.default_rng(8), np.empty(0, np.int64)
    first, second, weights = np.zeros(len(start)), np.zeros(len(start)), start.astype(float)
    for step in range(1, 26):
        if len(queue) < OPTIONS.batch:
            queue = np.concatenate([queue, draw.permutation(len(x))])
        take, queue = queue[: OPTIONS.batch], queue[OPTIONS.batch :]
        _, grads = plain.gradients(x[take], target[take])
        g = np.concatenate([grads[k].reshape(-1) for k in sorted(grads)]).astype(float)
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        rate = OPTIONS.rate * (1 - 0.9 * step / 25)
        weights -= rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * first / (np.sqrt(second) + 1e-8)
        plain = plain.with_flat(weights.astype(np.float32))
    assert np.abs(model.flat() - start).max() > 0.05
    # entries with gradients of rounding size only may go either way
    assert np.quantile(np.abs(model.flat() - weights), 0.99) < 1e-3


def test_lessons_are_made_a_batch_at_a_time():
    """A trainer holds its windows as they travel; the weights are those of lessons made before."""
    model, x, target = lessons()
    other, asked = model.with_flat(model.flat()), []

    def lesson(take):
        asked.append(len(take))
        return x[take], target[take]

    model.train(x, target, 30, seed=8)
    other.learn(len(x), lesson, 30, seed=8)
    assert len(asked) == 30 and max(asked) <= OPTIONS.batch
    assert np.array_equal(model.flat(), other.flat())


def test_rows_are_added_as_pairs():
    draw = np.random.default_rng(4)
    for width in (8, 5):
        flat, rows = np.zeros(1 + 9 * width, np.float32), draw.integers(0, 9, (7, 6))
        d = draw.standard_normal((7, 6, width)).astype(np.float32)
        table, want = flat[1:].reshape(9, width), np.zeros((9, width))
        np.add.at(want, rows, d)
        _add_rows(table, _places(rows, width), d)
        assert np.allclose(table, want, atol=1e-5)


def test_moments_without_gradients_do_not_linger_below_the_smallest_normal_number():
    """Such numbers take many times the time of others, and most tokens are rare."""
    weights = np.zeros(50, np.float32)
    adam = Adam(weights, 0.01, 1000)
    for step in range(1000):
        grads = np.zeros(50, np.float32)
        if step < 3:
            grads[: 10 * step] = 0.5
        adam.step(grads)
        small = np.abs(adam.first[adam.first != 0])
        assert not len(small) or small.min() > np.finfo(np.float32).tiny
    assert (adam.first == 0).all() and (weights[:20] < 0).all() and (weights[20:] == 0).all()
