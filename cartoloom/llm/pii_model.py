"""A character-level bidirectional LSTM with CRF transitions, in numpy: training by backpropagation, and decoding.

Every character has a row of gate inputs per direction (its embedding, already multiplied by the input weights), so a
time step costs one small matrix product.  Sigmoids are written as tanh, so that all gates take one call.
"""

from __future__ import annotations

import io
import unicodedata

import numpy as np

KINDS = ("email", "phone", "id_number", "address", "person")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
NO = np.float32(-1e4)


def tag_rules() -> tuple[np.ndarray, np.ndarray]:
    """Scores that forbid impossible transitions (an item continued that has not begun) and impossible starts."""
    t, s = np.zeros((len(TAGS), len(TAGS)), np.float32), np.zeros(len(TAGS), np.float32)
    for j, b in enumerate(TAGS):
        if b[0] == "I":
            s[j] = NO
            for i, a in enumerate(TAGS):
                if a not in (f"B{b[1:]}", b):
                    t[i, j] = NO
    return t, s


def shape_of(c: str) -> str:
    """The class of a character that is not in the vocabulary."""
    if c.isspace():
        return "\0space"
    return "\0" + unicodedata.category(c)[0 if not c.isalpha() else slice(0, 2)]


class Vocabulary:
    """Characters and classes of characters, as small numbers; 0 pads."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.code = {e: i for i, e in enumerate(entries)}
        self.table = np.zeros(65536, np.int16)
        for o in range(65536):
            c = chr(o)
            self.table[o] = self.code.get(c, self.code.get(shape_of(c), 1))

    @classmethod
    def of(cls, texts: list[str], least: int = 20) -> Vocabulary:
        count: dict[str, int] = {}
        for t in texts:
            for c in t:
                count[c] = count.get(c, 0) + 1
        chars = sorted(c for c, n in count.items() if n >= least)
        classes = ["\0space", "\0Lu", "\0Ll", "\0Lt", "\0Lm", "\0Lo", "\0N", "\0P", "\0S", "\0M", "\0Z", "\0C"]
        return cls(["\0pad", "\0other", *classes, *chars])

    def codes(self, text: str) -> np.ndarray:
        """One number per character."""
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        out = self.table[np.minimum(raw, 65535)]
        out[raw > 65535] = 1
        return out


class Tagger:
    """Parameters and the computations on them."""

    def __init__(self, vocabulary: Vocabulary, hidden: int = 64, seed: int = 1):
        r = np.random.default_rng(seed)
        v, h, k = len(vocabulary.entries), hidden, len(TAGS)
        self.vocabulary, self.hidden = vocabulary, h
        f = np.float32
        self.w = {
            "Pf": r.normal(0, 0.3, (v, 4 * h)).astype(f), "Pb": r.normal(0, 0.3, (v, 4 * h)).astype(f),
            "Uf": r.normal(0, 1 / np.sqrt(h), (h, 4 * h)).astype(f), "Ub": r.normal(0, 1 / np.sqrt(h), (h, 4 * h)).astype(f),
            "W": r.normal(0, 1 / np.sqrt(2 * h), (2 * h, k)).astype(f), "b": np.zeros(k, f),
            "T": np.zeros((k, k), f), "S": np.zeros(k, f),
        }
        for p in ("Pf", "Pb"):
            self.w[p][:, h : 2 * h] += 1.0  # forget gates start open

    # storage
    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, vocabulary=np.array([ord(e) if len(e) == 1 else -1 for e in self.vocabulary.entries], np.int32),
                            named=np.array([e for e in self.vocabulary.entries if len(e) > 1]), **{k: v.astype(np.float16) for k, v in self.w.items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tagger:
        with np.load(io.BytesIO(raw)) as z:
            named = iter(z["named"].tolist())
            entries = [chr(o) if o >= 0 else next(named) for o in z["vocabulary"].tolist()]
            # numpy strips leading NULs never, trailing ones always; class names end in letters
            t = cls(Vocabulary(entries), z["Uf"].shape[0])
            t.w = {k: z[k].astype(np.float32) for k in t.w}
        return t

    # network
    def _run(self, ids: np.ndarray, P: np.ndarray, U: np.ndarray, back: bool, keep: dict | None) -> np.ndarray:
        T, B = ids.shape
        H = self.hidden
        h, c = np.zeros((B, H), np.float32), np.zeros((B, H), np.float32)
        out = np.empty((T, B, H), np.float32)
        z, t = np.empty((B, 4 * H), np.float32), np.empty((B, H), np.float32)
        if keep is not None:
            keep |= {"gates": np.empty((T, B, 4 * H), np.float32), "cell": np.empty((T, B, H), np.float32), "before": np.empty((T, B, H), np.float32)}
        for s in range(T - 1, -1, -1) if back else range(T):
            np.dot(h, U, out=z)
            z += P[ids[s]]
            np.tanh(z, out=z)
            g = z[:, : 3 * H]
            g *= 0.5
            g += 0.5
            if keep is not None:
                keep["gates"][s] = z
                keep["before"][s] = c
            c *= z[:, H : 2 * H]
            np.multiply(z[:, :H], z[:, 3 * H :], out=t)
            c += t
            np.tanh(c, out=t)
            if keep is not None:
                keep["cell"][s] = t
            np.multiply(t, z[:, 2 * H : 3 * H], out=out[s])
            h = out[s]
        return out

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores (T, B, tags) of windows given as columns of character codes."""
        T, B = ids.shape
        f = self._run(ids, self.w["Pf"], self.w["Uf"], False, None)
        out = f.reshape(T * B, -1) @ self.w["W"][: self.hidden]
        del f
        b = self._run(ids, self.w["Pb"], self.w["Ub"], True, None)
        out += b.reshape(T * B, -1) @ self.w["W"][self.hidden :]
        out += self.w["b"]
        return out.reshape(T, B, -1)

    def loss_and_grads(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean CRF loss per window and the gradients of all parameters."""
        T, B = ids.shape
        H, K = self.hidden, len(TAGS)
        kf: dict = {}
        kb: dict = {}
        f = self._run(ids, self.w["Pf"], self.w["Uf"], False, kf)
        b = self._run(ids, self.w["Pb"], self.w["Ub"], True, kb)
        both = np.concatenate([f, b], axis=2).reshape(T * B, 2 * H)
        e = (both @ self.w["W"] + self.w["b"]).reshape(T, B, K)
        rule_t, rule_s = tag_rules()
        trans, start = self.w["T"] + rule_t, self.w["S"] + rule_s
        peak = trans.max()
        et = np.exp(trans - peak)
        alpha, norm = np.empty((T, B, K), np.float32), np.empty((T, B), np.float32)
        a = start + e[0]
        for s in range(T):
            if s:
                a = np.log(np.maximum(alpha[s - 1] @ et, 1e-30)) + peak + e[s]
            m = a.max(axis=1, keepdims=True)
            p = np.exp(a - m)
            z = p.sum(axis=1, keepdims=True)
            alpha[s] = p / z
            norm[s] = (m + np.log(z))[:, 0]
        total = norm.sum(axis=0)
        beta = np.ones((B, K), np.float32) / K
        gamma = np.empty((T, B, K), np.float32)
        gT = np.zeros((K, K), np.float32)
        gamma[T - 1] = alpha[T - 1]
        for s in range(T - 1, 0, -1):
            x = np.exp(e[s] - e[s].max(axis=1, keepdims=True)) * beta
            pair = (alpha[s - 1][:, :, None] * et[None]) * x[:, None, :]
            pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-30)
            gT += pair.sum(axis=0)
            gamma[s - 1] = pair.sum(axis=2)
            beta = x @ et.T
            beta /= np.maximum(beta.sum(axis=1, keepdims=True), 1e-30)
        at = np.arange(B)
        gold = start[tags[0]] + e[0, at, tags[0]]
        for s in range(1, T):
            gold = gold + trans[tags[s - 1], tags[s]] + e[s, at, tags[s]]
        loss = float((total - gold).mean())
        gE = gamma
        gE[np.arange(T)[:, None], at[None], tags] -= 1
        np.subtract.at(gT, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        gE /= B
        g = {"T": gT / B, "S": gE[0].sum(axis=0), "b": gE.sum(axis=(0, 1)), "W": both.T @ gE.reshape(T * B, K)}
        gh = (gE.reshape(T * B, K) @ self.w["W"].T).reshape(T, B, 2 * H)
        for p, u, keep, out, lo, back in (("Pf", "Uf", kf, f, 0, False), ("Pb", "Ub", kb, b, H, True)):
            g[p], g[u] = self._back(ids, self.w[u], keep, out, gh[:, :, lo : lo + H], back)
        return loss, g

    def _back(self, ids, U, keep, out, gh, back) -> tuple[np.ndarray, np.ndarray]:
        T, B = ids.shape
        H = self.hidden
        gz = np.empty((T, B, 4 * H), np.float32)
        dh, dc = np.zeros((B, H), np.float32), np.zeros((B, H), np.float32)
        for s in range(T) if back else range(T - 1, -1, -1):
            z, t = keep["gates"][s], keep["cell"][s]
            i, fo, o, n = z[:, :H], z[:, H : 2 * H], z[:, 2 * H : 3 * H], z[:, 3 * H :]
            d = gh[s] + dh
            dc = dc + d * o * (1 - t * t)
            q = gz[s]
            # a gate is 0.5 tanh(x) + 0.5, so its slope is 2 g (1 - g)
            q[:, :H] = dc * n * 2 * i * (1 - i)
            q[:, H : 2 * H] = dc * keep["before"][s] * 2 * fo * (1 - fo)
            q[:, 2 * H : 3 * H] = d * t * 2 * o * (1 - o)
            q[:, 3 * H :] = dc * i * (1 - n * n)
            dh = q @ U.T
            dc = dc * fo
        before = np.zeros_like(out)
        if back:
            before[:-1] = out[1:]
        else:
            before[1:] = out[:-1]
        flat = gz.reshape(T * B, 4 * H)
        gU = before.reshape(T * B, H).T @ flat
        codes = ids.ravel()
        order = np.argsort(codes, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(codes[order]) != 0)))
        gP = np.zeros((len(self.vocabulary.entries), 4 * H), np.float32)
        gP[codes[order][first]] = np.add.reduceat(flat[order], first, axis=0)
        return gP, gU

    def fit(
        self, ids: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 4e-3, seed: int = 1, seconds: float = 1e9, workers: int = 1, log=None
    ) -> None:
        """Adam on windows ``(n, T)`` of character codes and tags; each batch is shared out over the worker processes."""
        import multiprocessing
        import time
        from contextlib import nullcontext

        with multiprocessing.get_context("fork").Pool(workers) if workers > 1 else nullcontext() as pool:
            self._fit(ids, tags, epochs, batch, rate, seed, seconds, workers, pool, log, time)

    def _gradients(self, x: np.ndarray, y: np.ndarray, workers: int, pool) -> tuple[float, dict]:
        if pool is None:
            return self.loss_and_grads(x, y)
        parts = [(self.vocabulary.entries, self.hidden, self.w, np.ascontiguousarray(a), np.ascontiguousarray(b)) for a, b in zip(np.array_split(x, workers, 1), np.array_split(y, workers, 1))]
        got = pool.map(_one_part, parts, 1)
        share = [p[3].shape[1] / x.shape[1] for p in parts]
        return sum(w * g[0] for w, g in zip(share, got)), {k: sum(w * g[1][k] for w, g in zip(share, got)) for k in self.w}

    def _fit(self, ids, tags, epochs, batch, rate, seed, seconds, workers, pool, log, time) -> None:

        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        step, began, steps = 0, time.time(), epochs * max(1, len(ids) // batch)
        for epoch in range(epochs):
            order, losses = r.permutation(len(ids)), []
            for i in range(0, len(order) - batch + 1, batch):
                if time.time() - began > seconds:
                    return
                own = order[i : i + batch]
                loss, g = self._gradients(np.ascontiguousarray(ids[own].T), np.ascontiguousarray(tags[own].T), workers, pool)
                losses.append(loss)
                step += 1
                size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                scale = min(1.0, 5.0 / max(size, 1e-9))
                done = max(step / steps, (time.time() - began) / seconds)
                now = rate * min(1.0, step / 50) * (0.02 + 0.98 * max(0.0, 1 - done))
                for k, x in g.items():
                    x = x * scale
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.999 * v[k] + 0.001 * x * x
                    self.w[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            if log:
                log(f"epoch {epoch + 1}: loss {np.mean(losses):.3f}, {time.time() - began:.0f} s")

    def best_paths(self, e: np.ndarray) -> np.ndarray:
        """Viterbi tags (T, B) of scores (T, B, tags).

        Tags lie along the first axis, so that every maximum runs over whole rows of windows; only the way back needs
        to know where a maximum came from, and finds it again from the stored scores.
        """
        T, B, K = e.shape
        rule_t, rule_s = tag_rules()
        trans = (self.w["T"] + rule_t).astype(np.float32)
        e = np.ascontiguousarray(e.transpose(0, 2, 1))
        a = np.empty((T, K, B), np.float32)
        a[0] = (self.w["S"] + rule_s)[:, None] + e[0]
        begin, inside = np.arange(1, K, 2), np.arange(2, K, 2)
        free = [0, *begin.tolist()]  # tags that may follow any tag
        rows = [np.ascontiguousarray(trans[:, j])[:, None] for j in free]
        from_b, from_i = trans[begin, inside][:, None], trans[inside, inside][:, None]
        x = np.empty((K, B), np.float32)
        for s in range(1, T):
            was, now = a[s - 1], a[s]
            for j, row in zip(free, rows):
                np.add(was, row, out=x)
                x.max(axis=0, out=now[j])
            now[2::2] = np.maximum(was[1::2] + from_b, was[2::2] + from_i)
            now += e[s]
        out = np.empty((T, B), np.int8)
        out[T - 1] = a[T - 1].argmax(axis=0)
        by_tag = np.ascontiguousarray(trans)
        for s in range(T - 1, 0, -1):
            out[s - 1] = (a[s - 1] + by_tag[:, out[s]]).argmax(axis=0)
        return out


_PARTS: dict = {}


def _one_part(part: tuple) -> tuple[float, dict]:
    entries, hidden, w, x, y = part
    if "tagger" not in _PARTS:
        _PARTS["tagger"] = Tagger(Vocabulary(entries), hidden)
    _PARTS["tagger"].w = w
    return _PARTS["tagger"].loss_and_grads(x, y)
