"""Problem 4: replies that are no usable answer, with the kind of defect.

A multi-label linear classifier decides every label. Its features are hashed word n-grams of the reply, features of the pair,
and the evidence of an early stop that problem 5's operator finds over the whole corpus. It is trained on all real pairs of
the corpus, taken as sound, and on synthetic defects made from each of them: replies emptied,
copied from the question in several guises, swapped for one in another language, replaced by a refusal, cut short; and on
sound pairs that look alike: a question restated before the answer, an answer in the language that the question asks for, an
answer after an apology, one of a word, of code or of a tool call alone. No row is left out: every task descends over all
of its rows, block by block, and the tasks' weights are averaged, each weight by the gradients that made it. Rows form two
folds by a hash; each fold's pairs are scored by the other fold's model, and over all these scores each threshold stands at
its best F1. Replies are judged by the mean of both models.

Languages aren't given but learnt: the texts of the corpus form clusters by their character trigrams (a mixture of
multinomials, fitted by expectation maximisation in rounds over all texts, from texts of every task that are unlike each
other), and how often two clusters stand in one real pair, against chance, tells whether they are one language.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import truncation
from siltworks.llm.common import norm_role
from siltworks.llm.tokens import classes, mix, tokenize
from siltworks.session import discard, written

LABELS = ("empty", "copy", "refusal", "truncated", "language")
EVIDENCE = ("prefix", "limit", "sentence", "open", "word")
BITS = 16  # hashed n-grams; those of questions that differ in language have the upper half
GRAM_BITS, CLUSTERS = 12, 16
BLOCK_ROWS = 1500  # rows whose examples are held as arrays at once; the next rows follow
BLOCK_CHARS = 4_000_000  # a block ends before its rows if they have so many characters
ASKING = 4.0  # n-grams of a question weigh as one of so many
EM_STARTS, EM_TEXTS = 8, 64  # starts, of which the likeliest is taken, and texts of a task from which they are made
EM_ROUNDS, EM_GAIN = 8, 1e-3  # rounds over the corpus end when the likelihood gains less than this share
BINS, BIN = 4096, 1 / 64  # bins of scores from which thresholds are set
PART = 500  # texts or pairs that are held as arrays at once
SAME = 0.1  # the least share of a cluster's pairs that makes another cluster the same language
_THINK = re.compile(r"<think>.*?</think>", re.DOTALL | re.IGNORECASE)
_CALL = re.compile(r"<tool_call>.*?(?:</tool_call>|$)", re.DOTALL)
_FENCE = re.compile(r"```.*?(?:```|$)", re.DOTALL)
_TICK = re.compile(r"`[^`\n]*`")
_LINES = re.compile(r"^[ \t]*(?:[^\w\s\"'¿¡«“(*>-].*|.*[_:=/\\]\w.*|\d.*)$", re.MULTILINE)  # lines of code, paths, figures: no prose
_MARKS = re.compile(r"</?think>|```\w*|[\s​-‏⁠﻿­\u0000-\u001f ㅤ]+", re.IGNORECASE)
_BARE = re.compile(rf"(?>{_MARKS.pattern})*+", re.IGNORECASE)
_NOT_WORD = re.compile(r"[\W_]+")
_M = 2**64 - 1
#: Phrases from which training data are made: refusals (beginning, reason, end), and requests for an answer in a language.
REFUSALS = {
    "en": (["I'm sorry, but I can't help with that", "I cannot assist with this request", "I can’t comply with that", "Sorry, I am unable to answer this", "Unfortunately I am not able to provide this", "I must decline this request", "I won't be able to help here", "I'd rather not work on this one", "As an AI, I cannot provide that", "I am not allowed to discuss this", "That is something I can't do"], ["", ", since it goes against my guidelines", " for policy reasons", " at this time", " because I have no access to that", " as it may be unsafe"], ["", " Please consult a professional.", " Feel free to ask something else.", " Thank you for understanding.", " Is there anything else?"]),
    "de": (["Es tut mir leid, dabei kann ich nicht helfen", "Diese Anfrage muss ich leider ablehnen", "Dazu darf ich keine Auskunft geben", "Leider kann ich das nicht beantworten", "Ich kann diese Bitte nicht erfüllen"], ["", ", da es gegen die Richtlinien verstößt", ", aus Sicherheitsgründen"], ["", " Kann ich sonst etwas tun?", " Bitte fragen Sie etwas anderes."]),
    "fr": (["Je suis désolé, je ne peux pas vous aider", "Il m'est impossible de répondre à cela", "Je ne suis pas en mesure de traiter cette demande", "Désolé, je dois refuser cette demande", "Je regrette, mais je ne peux pas répondre"], ["", ", car cela enfreint mes règles", ", pour des raisons de sécurité"], ["", " Posez-moi une autre question.", " Merci de votre compréhension."]),
    "es": (["Lo siento, no puedo ayudar con eso", "No me es posible responder a esta solicitud", "Debo rechazar esta petición", "Lamentablemente no puedo atender esta solicitud", "No estoy autorizado a dar esa información"], ["", ", porque va contra mis normas", ", por motivos de seguridad"], ["", " Pregúntame otra cosa.", " Gracias por su comprensión."]),
    "ru": (["Извините, я не могу помочь с этим", "К сожалению, я не могу ответить на этот вопрос", "Я вынужден отказаться от этого запроса", "Простите, но выполнить эту просьбу я не могу", "Я не вправе обсуждать эту тему"], ["", ", так как это нарушает правила", ", по соображениям безопасности"], ["", " Задайте другой вопрос.", " Спасибо за понимание."]),
    "zh": (["抱歉，我无法协助处理这个请求", "对不起，作为人工智能助手，我不能提供相关内容", "很遗憾，这个问题我不能回答", "这个要求我没办法满足", "不好意思，我不能帮你完成这件事"], ["", "，因为这不符合使用规范", "，出于安全方面的考虑"], ["", "。如果还有其他问题，欢迎继续提问", "。请换一个问题"]),
}
LANGUAGE_NAMES = {
    "en": ("English", "German", "French", "Spanish", "Russian", "Chinese", "Italian", "Portuguese", "Japanese"), "de": ("Englisch", "Deutsch", "Französisch", "Spanisch", "Russisch", "Chinesisch"), "fr": ("anglais", "allemand", "français", "espagnol", "russe", "chinois"),
    "es": ("inglés", "alemán", "francés", "español", "ruso", "chino"), "ru": ("английском", "немецком", "французском", "испанском", "русском", "китайском"), "zh": ("英文", "德文", "法文", "西班牙文", "俄文", "中文"),
}
REQUESTS = {
    "en": ("Answer in {}.", "Please reply in {}.", "Write it in {}, please.", "Explain this in {}.", "I need the answer in {}.", "Translate your reply to {}."), "de": ("Antworte auf {}.", "Bitte auf {} erklären.", "Schreibe die Antwort auf {}."),
    "fr": ("Réponds en {}.", "Explique-le en {}, s'il te plaît.", "Écris la réponse en {}."), "es": ("Responde en {}.", "Explícalo en {}, por favor.", "Escribe la respuesta en {}."), "ru": ("Ответь на {}.", "Напиши ответ на {} языке."), "zh": ("请用{}回答。", "用{}解释一下。"),
}


def answer(v: str | None) -> str:
    """A reply without its closed think blocks."""
    return _THINK.sub(" ", v) if v and "<think>" in v.lower() else v or ""


def bare(v: str | None) -> bool:
    """Null, or nothing beside white space, invisible characters and think or code marks."""
    return v is None or _BARE.fullmatch(v) is not None


def prose(t: str) -> str:
    """A text without code, tool calls and pasted output."""
    if "<tool_call>" in t:
        t = _CALL.sub(" ", t)
    if "`" in t:
        t = _TICK.sub(" ", _FENCE.sub(" ", t))
    t = t.strip()
    return _LINES.sub(" ", t) if "\n" in t or t[:1] in "{[" else t


_tables: dict[str, np.ndarray] = {}


def _letter() -> np.ndarray:
    """By code point: the letter itself, a blank for what is none."""
    if "letter" not in _tables:
        code = np.arange(0x110000, dtype=np.uint64)
        _tables["letter"] = np.where((classes() > 0) & ~((code >= 48) & (code <= 57)), code, np.uint64(32))
    return _tables["letter"]


def letters(texts: list[str]) -> list[str]:
    """The texts in lower case without what :data:`_NOT_WORD` finds."""
    if "alnum" not in _tables:
        _tables["alnum"] = np.zeros(0x110000, bool)
        _tables["alnum"][[i for i in range(0x40000) if chr(i).isalnum()]] = True
    low = [t.lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = _tables["alnum"][code]
    kept = code[keep].tobytes().decode("utf-32-le")
    at = np.concatenate([[0], np.cumsum(keep)])[np.cumsum([0, *map(len, low)])].tolist()
    return [kept[i:j] for i, j in zip(at, at[1:], strict=False)]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams over letters, any run of other characters being one blank, and the text of each."""
    low = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(low)), [len(t) for t in low])
    sym = _letter()[code]
    letter = sym != 32
    keep = np.concatenate([[True], letter[1:] | letter[:-1] | (of[1:] != of[:-1])]) if len(sym) else np.zeros(0, bool)
    sym, of = sym[keep], of[keep]
    if len(sym) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = (sym[:-2] << np.uint64(42)) | (sym[1:-1] << np.uint64(21)) | sym[2:]
    ok = of[:-2] == of[2:]
    return (mix(h[ok]) >> np.uint64(64 - GRAM_BITS)).astype(np.int64), of[:-2][ok]


def _score(table: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sums of each text's rows of ``table``, column by column, so that one column is in the cache."""
    return np.stack([np.add.reduceat(column.take(ids), first) for column in np.ascontiguousarray(table.T)], 1)


def unlike(texts: list[str], times: np.ndarray, k: int, rng: np.random.Generator) -> tuple[list[int], np.ndarray]:
    """k of the texts, each drawn by how little it is like those before and how many texts it stands for (``times``); and how like each text is to each of them."""
    ids, of = trigrams(texts)
    near = np.zeros((len(texts), 0))
    if not len(ids):
        return [], near
    has, first = np.unique(of, return_index=True)
    size = np.diff(np.append(first, len(of)))
    weight = 1 / np.log(np.bincount(ids, minlength=2**GRAM_BITS) + 2.0)
    own = weight[ids]
    total = np.add.reduceat(own, first)
    enough = np.nonzero(size >= 40)[0] if (size >= 40).any() else np.arange(len(has))
    n = times[has[enough]] / times[has[enough]].sum()
    seeds, cols = [int(rng.choice(enough, p=n))], []
    for _ in range(k):
        mark = np.zeros(2**GRAM_BITS)
        mark[ids[first[seeds[-1]] : first[seeds[-1]] + size[seeds[-1]]]] = 1
        cols.append(np.add.reduceat(mark[ids] * own, first) / total)
        far = n * (1 - np.max(cols, axis=0)[enough]) ** 4
        seeds.append(int(rng.choice(enough, p=far / far.sum()) if far.sum() > 0 else rng.choice(enough, p=n)))
    near = np.zeros((len(texts), k))
    near[has] = np.stack(cols, 1)
    return [int(has[i]) for i in seeds[:k]], near


class Languages:
    """Clusters of texts by their trigrams, and which clusters stand together in pairs."""

    def __init__(self, questions: list[str], answers: list[str], k: int = CLUSTERS, rounds: int = 25, seed: int = 5, times: np.ndarray | None = None) -> None:
        texts = questions + answers
        times = np.ones(len(texts)) if times is None else times
        self.table, self.prior = np.zeros((2**GRAM_BITS, k), np.float32), np.zeros(k)
        self.together, self.group, self.fit = np.zeros((k, k)), np.arange(k), -np.inf
        ids, of = trigrams(texts)
        if not len(ids):
            return
        own = unlike(texts, times, k, np.random.default_rng(seed))[1]
        has, first = np.unique(of, return_index=True)
        own = own[has]
        own = (own == own.max(1, keepdims=True)).astype(np.float32)
        own /= own.sum(1, keepdims=True)
        size, times = np.diff(np.append(first, len(of))), times[has]
        for _ in range(rounds):
            self.refit(self._sums(ids, size, own * times[:, None]), (own * times[:, None]).sum(0))
            score = _score(self.table, ids, first) + self.prior
            most = score.max(1, keepdims=True)
            new = np.exp(score - most)
            self.fit = float((times[:, None] * (np.log(new.sum(1, keepdims=True)) + most)).sum())
            new = (new / new.sum(1, keepdims=True)).astype(np.float32)
            moved = float(np.abs(new - own).sum()) / len(has)
            own = new
            if moved < 1e-3:
                break
        if questions and answers:
            self.link(self.met(self.of(questions), self.of(answers)))

    @staticmethod
    def _sums(ids: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
        """How often each cluster has each trigram, given the texts' shares of the clusters."""
        most, rest, k = own.argmax(1), own.copy(), own.shape[1]
        cell = ids + (np.repeat(most, size) << GRAM_BITS)
        out = np.bincount(cell, weights=np.repeat(own.max(1), size), minlength=k << GRAM_BITS).reshape(k, -1).T
        rest[np.arange(len(own)), most] = 0
        some = rest.any(1)  # few texts belong to more than one cluster
        ids, size, rest = ids[np.repeat(some, size)], size[some], rest[some]
        for j in np.nonzero(rest.any(0))[0]:
            out[:, j] += np.bincount(ids, weights=np.repeat(rest[:, j], size), minlength=2**GRAM_BITS)
        return out

    def refit(self, sums: np.ndarray, mass: np.ndarray) -> None:
        n = sums + 0.02
        self.table = np.log(n / n.sum(0)).astype(np.float32)
        self.prior = np.log((mass + 1) / (mass.sum() + len(mass)))

    def step(self, texts: list[str], least: int = 12) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
        """What :meth:`refit` needs of these texts, by the clusters so far: trigrams and texts of each cluster; the texts' log likelihood; and the cluster of each text."""
        if len(texts) > PART:
            parts = [self.step(texts[i : i + PART], least) for i in range(0, len(texts), PART)]
            return sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts), np.concatenate([p[3] for p in parts])
        ids, of = trigrams(texts)
        k, best = len(self.prior), np.full(len(texts), -1)
        if not len(ids):
            return np.zeros((2**GRAM_BITS, k)), np.zeros(k), 0.0, best
        has, first = np.unique(of, return_index=True)
        size = np.diff(np.append(first, len(of)))
        plain = _score(self.table, ids, first)
        score = plain + self.prior
        most = score.max(1, keepdims=True)
        own = np.exp(score - most)
        total = own.sum(1, keepdims=True)
        own /= total
        own[own < 1e-6] = 0
        best[has[size >= least]] = plain.argmax(1)[size >= least]
        return self._sums(ids, size, own), own.sum(0), float((np.log(total) + most).sum()), best

    def met(self, q: np.ndarray, a: np.ndarray) -> np.ndarray:
        """How many pairs have a question of one cluster and a reply of another."""
        both = (q >= 0) & (a >= 0)
        n = np.zeros_like(self.together)
        np.add.at(n, (q[both], a[both]), 1)
        return n

    def link(self, n: np.ndarray) -> None:
        """Clusters that many pairs join are one language, the closest first, so that a small cluster of texts of two languages
        goes to one of them and doesn't join both; which languages stand together, from the pairs' counts by cluster."""
        n, k = n + n.T, len(n)
        of = np.eye(k)
        while True:
            m = of.T @ n @ of
            share = np.where(m >= 3, m / np.maximum(np.minimum.outer(m.sum(1), m.sum(1)), 1), 0)
            np.fill_diagonal(share, 0)
            i, j = np.unravel_index(share.argmax(), share.shape)
            if share[i, j] < SAME:
                break
            of[:, i] += of[:, j]
            of[:, j] = 0
        self.group = np.unique(of.argmax(1), return_inverse=True)[1]
        of = np.eye(k)[self.group]
        n = of.T @ n @ of
        chance = np.outer(n.sum(1), n.sum(0)) / max(n.sum(), 1)
        self.together = np.log((n + 0.25) / (chance + 0.25))

    def of(self, texts: list[str], least: int = 12) -> np.ndarray:
        """The language (a group of clusters) of each text, -1 for texts of few letters."""
        if len(texts) > PART:
            return np.concatenate([self.of(texts[i : i + PART], least) for i in range(0, len(texts), PART)])
        out = np.full(len(texts), -1)
        ids, of = trigrams(texts)
        if not len(ids):
            return out
        has, first = np.unique(of, return_index=True)
        score = _score(self.table, ids, first)
        long_ = np.diff(np.append(first, len(of))) >= least
        out[has[long_]] = self.group[score.argmax(1)[long_]]
        return out


def repeats(q: str, a: str) -> tuple[float, float, float]:
    """How far ``a`` is ``q`` over again: whether one holds the other, letters only; the share that it has of the longer one; what ``a`` adds."""
    return _over(_NOT_WORD.sub("", q.lower()), _NOT_WORD.sub("", a.lower()))


def _over(x: str, y: str) -> tuple[float, float, float]:
    if not x or not y:
        return 0.0, 0.0, 0.0
    inside = x in y or y in x
    return float(inside), min(len(x), len(y)) / max(len(x), len(y)) if inside else 0.0, min(max(len(y) - len(x), 0) / 24, 4.0) if inside else 0.0


DENSE = ("bias", "bare", "inside", "share", "most", "added", "apart", "near", "unknown", "short", "code", "call", "words", *EVIDENCE)
Pair = tuple[str | None, str | None, str | None]  # question, reply, evidence of an early stop


class Texts:
    """What the classifier reads of texts, each text once: of replies, or of questions."""

    def __init__(self, languages: Languages, questions: bool = False) -> None:
        self.languages, self.questions, self.at = languages, questions, {}
        self.language, self.words, self.letters = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        self.form = np.zeros((0, 3), bool)  # bare, code, call
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)  # n-grams of replies, text after text

    def look(self, texts: list[str | None]) -> np.ndarray:
        """The place of each text; those not seen before are read."""
        seen, at = len(self.at), self.at
        out = np.array([at.setdefault(t, len(at)) for t in texts], np.int64)
        new = list(islice(at, seen, None))
        parts = [self._read(new[i : i + PART]) for i in range(0, len(new), PART)]
        for name, got in zip(("language", "words", "form", "ids", "size"), zip(*parts, strict=True), strict=False):
            setattr(self, name, np.concatenate([getattr(self, name), *got]))
        return out

    def _read(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        whole = texts if self.questions else [answer(a) for a in texts]
        plain = [prose(t) for t in whole]
        self.letters += letters(whole)
        language = self.languages.of(plain)
        if self.questions:
            return (language,)
        words, ids, size = grams(plain, 0)
        return language, words, np.array([(bare(t), "`" in a, "<tool_call>" in a) for t, a in zip(texts, whole, strict=True)], bool).reshape(-1, 3), ids, size


def grams(texts: list[str], base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; hashed ids of its words and pairs of words, text after text, and how many each has."""
    t = tokenize(texts)
    words = np.bincount(t.doc, minlength=len(texts))
    two = np.maximum(words - 1, 0)
    out = np.zeros(len(t.h) + two.sum(), np.int32)
    if len(t.h):
        hid = lambda h: (mix(h) >> np.uint64(65 - BITS)).astype(np.int32) + np.int32(base)
        same = t.doc[:-1] == t.doc[1:]
        out[np.arange(len(t.h)) + (np.cumsum(two) - two)[t.doc]] = hid(t.h)
        out[np.arange(two.sum()) + np.cumsum(words)[t.doc[:-1][same]]] = hid((t.h[:-1] * np.uint64(0x9E3779B97F4A7C15) + t.h[1:])[same])
    return words, out, words + two


@dataclass
class Features:
    """Of pairs: ``dense`` features, and which texts' n-grams count (``text`` of ``pair``): the reply's, then the question's where the languages
    differ. Of these texts: hashed ``ids``, which begin at ``start``, and the ``weight`` of one."""

    dense: np.ndarray
    text: np.ndarray
    pair: np.ndarray
    ids: np.ndarray
    start: np.ndarray
    weight: np.ndarray


class Model:
    """One linear model a label: dense weights, hashed weights (mean over a pair's n-grams) and a threshold."""

    def __init__(self, languages: Languages) -> None:
        self.languages = languages
        self.dense, self.hashed, self.at = np.zeros((len(DENSE), len(LABELS)), np.float32), np.zeros((2**BITS, len(LABELS)), np.float32), np.zeros(len(LABELS))

    def features(self, pairs: list[Pair], replied: Texts | None = None, asked: Texts | None = None) -> Features:
        """Features of the pairs; ``replied`` and ``asked`` may hold texts read before."""
        replied, asked = replied or Texts(self.languages), asked or Texts(self.languages, True)
        at_a, at_q = replied.look([a for _, a, _ in pairs]), asked.look([q or "" for q, _, _ in pairs])
        la, lq, n = replied.language[at_a], asked.language[at_q], replied.words[at_a]
        together = np.where((la >= 0) & (lq >= 0), self.languages.together[lq, la], 0.0)
        dense = np.zeros((len(pairs), len(DENSE)), np.float32)
        over = np.array([_over(asked.letters[x], replied.letters[y]) for x, y in zip(at_q.tolist(), at_a.tolist(), strict=True)]).reshape(-1, 3)
        dense[:, 0], dense[:, 2:4], dense[:, 4], dense[:, 5] = 1, over[:, :2], over[:, 1] > 0.7, over[:, 2]
        dense[:, [1, 10, 11]] = replied.form[at_a]
        dense[:, 6], dense[:, 7], dense[:, 8] = np.clip(-together, 0, 3) / 3, np.clip(together, 0, 3) / 3, (la < 0) | (lq < 0)
        dense[:, 9], dense[:, 12] = n < 12, np.minimum(n, 100) / 50
        why = [(i, EVIDENCE.index(e)) for i, (_, _, e) in enumerate(pairs) if e]
        if why:
            i, e = np.array(why).T
            dense[i, len(DENSE) - len(EVIDENCE) + e] = 1
        apart = np.nonzero(together < 0)[0]  # what a question asks for matters where the languages differ
        own, at = np.unique(at_q[apart], return_inverse=True)
        texts = list(asked.at) if len(own) else []
        parts = [grams([texts[i] for i in own[lo : lo + PART]], 2 ** (BITS - 1))[1:] for lo in range(0, len(own), PART)]
        ids, size = np.concatenate([replied.ids, *[p[0] for p in parts]]), np.concatenate([replied.size, *[p[1] for p in parts]])
        weight = np.concatenate([1 / np.maximum(replied.size, 1), np.full(len(own), 1 / ASKING)])
        return Features(dense, np.concatenate([at_a, at + len(replied.size)]), np.concatenate([np.arange(len(pairs)), apart]), ids, np.concatenate([[0], np.cumsum(size)]), weight)

    def raw(self, f: Features) -> np.ndarray:
        """Scores; n-grams of a reply count as their mean, those of a question as their sum over ASKING."""
        out = np.einsum("ij,jk->ik", f.dense, self.dense)  # not by threads that wait for each other
        n = len(f.weight)
        of = np.repeat(np.arange(n), np.diff(f.start))
        for k in range(len(LABELS)):
            text = np.bincount(of, weights=self.hashed[:, k][f.ids], minlength=n) * f.weight
            out[:, k] += np.bincount(f.pair, weights=text[f.text], minlength=len(out))
        return out

    def scores(self, pairs: list[Pair]) -> np.ndarray:
        return self.raw(self.features(pairs)) - self.at


def _refusal(rng: random.Random, lang: str) -> str:
    a, b, c = REFUSALS[lang]
    x = rng.choice(a) + rng.choice(b) + ("。" if lang == "zh" else ".") + rng.choice(c)
    return x.replace("'", "’") if rng.random() < 0.2 else x


_COPIES = (lambda s: s, str.upper, str.lower, lambda s: f'"{s}"', lambda s: f"> {s}", lambda s: f"Question: {s}", lambda s: s.replace(" ", "  "), lambda s: s.rstrip(".?!。？！"), lambda s: f"You asked: {s}", lambda s: f"{s}\n\n{s}")


def _copy(rng: random.Random, q: str) -> str:
    return rng.choice(_COPIES)(q)


def _empty(rng: random.Random) -> str | None:
    return rng.choice((None, "", " ", "\n\n", "​", "<think>\n\n</think>", "<think></think>\n", "```\n```", "```python\n\n```"))


def synthesise(pairs: list[Pair], languages: Languages, seed: int = 7, known: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[list[Pair], np.ndarray, np.ndarray]:
    """Labelled pairs: each real pair, taken as sound, one copy of it with each synthetic defect, and sound ones that look alike; and which are the real ones. ``known``: the languages of the replies and of the questions."""
    rng, out, y, real = random.Random(seed), [], [], []
    of, asks = known or (languages.of([prose(answer(a)) for _, a, _ in pairs]), languages.of([prose(q or "") for q, _, _ in pairs]))
    long_ = [i for i, (_, a, _) in enumerate(pairs) if of[i] >= 0 and len(a or "") > 60]
    names = list(REFUSALS)

    def add(pair: Pair, *labels: str, own: bool = False) -> None:
        out.append(pair)
        real.append(own)
        y.append([k in labels for k in LABELS])

    for i, (q, a, e) in enumerate(pairs):
        add((q, a, e), own=True)
        add((q, _copy(rng, q), None), "copy")
        lang = rng.choice(names)
        add((q, _refusal(rng, lang), None), "refusal")
        add((q, _empty(rng), None), "empty")
        if i % 16 == 0:
            add((q, f"{q}\n\n{a}", e))
            if len(a or "") > 200:
                add((q, f"{_refusal(rng, lang)} {a}", e))
        if i % 3 == 0:  # short answers, code and calls alone are sound
            word = _NOT_WORD.split((a or "").strip() or "x")
            add((q, rng.choice((f"{rng.choice(word)}.", rng.choice(word), str(rng.randrange(1000)), f"```\n{' '.join(word[:3])}\n```", f"```python\n{word[0]} = {rng.randrange(99)}\n```", f'<tool_call>{{"name": "{word[-1] or "x"}", "arguments": {{}}}}</tool_call>')), None))
        others = [j for j in rng.sample(long_, min(len(long_), 12)) if asks[i] >= 0 and languages.together[asks[i], of[j]] < -1.5]
        if others:
            a2, e2 = pairs[others[0]][1], pairs[others[0]][2]
            add((q, a2, e2), *(["language"] if not e2 else ["language", "truncated"]))
            for of_ask in ("en", lang):
                ask = rng.choice(REQUESTS[of_ask]).format(rng.choice(LANGUAGE_NAMES[of_ask]))
                add((f"{q} {ask}" if rng.random() < 0.8 else f"{ask} {q}", a2, e2))
    return out, np.array(y, np.float32).reshape(-1, len(LABELS)), np.array(real, bool)


def cuts(pairs: list[Pair], seed: int = 11) -> list[Pair]:
    """Copies of the pairs with a reply cut short at a random place."""
    rng = random.Random(seed)
    return [(q, a[: rng.randrange(15, len(a) - 8)], None) for q, a, _ in pairs if a and len(a) > 30]


class Examples:
    """Labelled pairs of a block as arrays: features, labels, and which are real."""

    def __init__(self, pairs: list[Pair], cut: list[Pair], languages: Languages, seed: int = 7) -> None:
        replied, asked = Texts(languages), Texts(languages, True)
        at_a, at_q = replied.look([a for _, a, _ in pairs]), asked.look([q or "" for q, _, _ in pairs])
        examples, self.y, self.real = synthesise(pairs, languages, seed, (replied.language[at_a], asked.language[at_q]))
        cut = [c for c in cut if c[2]]  # one that happens to end with a sentence is no early stop
        if cut:
            examples, self.real = examples + cut, np.concatenate([self.real, np.zeros(len(cut), bool)])
            self.y = np.concatenate([self.y, np.tile([k == "truncated" for k in LABELS], (len(cut), 1)).astype(np.float32)])
        self.size = len(examples)
        if examples:
            self.f = Model(languages).features(examples, replied, asked)


class Descent:
    """Weights of a model on their way, with their sums of squared gradients and the sum of the later epochs' weights."""

    def __init__(self, seed: int = 3) -> None:
        self.wd, self.wh = np.zeros((len(DENSE), len(LABELS))), np.zeros((len(LABELS), 2**BITS))
        self.md, self.mh = np.full_like(self.wd, 1e-6), np.full_like(self.wh, 1e-6)
        self.sd, self.sh, self.times = np.zeros_like(self.wd), np.zeros_like(self.wh), 0
        self.rng = np.random.default_rng(seed)

    def into(self, model: Model, mean: bool = True) -> Model:
        model.dense, model.hashed = (self.sd / max(self.times, 1), (self.sh / max(self.times, 1)).T) if mean else (self.wd, self.wh.T)
        return model

    def learn(self, x: Examples, model: Model, use: np.ndarray, epochs: int, batch: int) -> np.ndarray:
        """``epochs`` over the examples in ``use``. Halfway, what is taken as sound but looks defective: real refusals, copies and early stops become examples, the others are left out. Returns what looks so."""
        f, d = x.f, x.f.dense
        asking = f.text[x.size :]  # the texts of questions that count, by pair
        ask = np.full(x.size, -1)
        ask[f.pair[x.size :]] = asking
        decay = np.where(np.arange(2**BITS) >= 2 ** (BITS - 1), 1e-4, 1e-6)
        odd = np.zeros(x.size, bool)
        for epoch in range(epochs):
            if epoch == epochs // 2:
                s = self.into(model, mean=False).raw(x.f)
                odd = (x.y.sum(1) == 0) & (s > 0).any(1)
                sure = odd & x.real & (s.max(1) > 1) & (s.argmax(1) < LABELS.index("language"))
                x.y[sure, s[sure].argmax(1)] = 1
                use = use & ~(odd & ~sure)
            rows = self.rng.permutation(np.nonzero(use)[0])
            for lo in range(0, len(rows), batch):
                r = rows[lo : lo + batch]
                has = np.nonzero(ask[r] >= 0)[0]
                text, of = np.concatenate([f.text[r], ask[r[has]]]), np.concatenate([np.arange(len(r)), has])
                size = f.start[text + 1] - f.start[text]
                text, of, size = text[size > 0], of[size > 0], size[size > 0]
                first, w = np.cumsum(size) - size, f.weight[text]
                i = f.ids[np.arange(size.sum()) + np.repeat(f.start[text] - first, size)].astype(np.int64)
                s = d[r] @ self.wd
                for k in range(len(LABELS) if len(i) else 0):
                    s[:, k] += np.bincount(of, weights=np.add.reduceat(self.wh[k].take(i), first) * w, minlength=len(r))
                g = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - x.y[r]) / len(r)
                gd = d[r].T @ g + 1e-4 * self.wd
                self.md += gd**2
                self.wd -= 0.3 * gd / np.sqrt(self.md)
                hit = np.zeros(2**BITS, bool)
                hit[i] = True
                u = np.nonzero(hit)[0]  # only the buckets in this batch
                du, gt = decay[u], g[of] * w[:, None]
                for k in range(len(LABELS)):
                    wk, mk = self.wh[k], self.mh[k]
                    wu = wk.take(u)
                    gh = np.bincount(i, weights=np.repeat(gt[:, k], size), minlength=2**BITS).take(u) + du * wu
                    mu = mk.take(u) + gh**2
                    mk[u], wk[u] = mu, wu - 0.3 * gh / np.sqrt(mu)
            if epoch > epochs // 2:
                self.sd, self.sh, self.times = self.sd + self.wd, self.sh + self.wh, self.times + 1
        return odd


def train(pairs: list[Pair], cut: list[Pair], languages: Languages, steps: int = 300, batch: int = 384, seed: int = 3) -> Model:
    """Fits a model in memory on real pairs, synthetic defects and ``cut`` pairs, and sets each label's threshold at its best F1 on a held-out fifth."""
    x, model, fit = Examples(pairs, cut, languages), Model(languages), Descent(seed)
    if not x.size:
        return model
    held = np.arange(x.size) % 5 == 4
    held &= ~fit.learn(x, model, ~held, max(8, -(-steps * batch // x.size)), batch)
    s = fit.into(model).raw(x.f)
    model.at = best_f1(counted(s[held], x.y[held]))
    return model


def counted(s: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many scores fall in each bin, and how many of them have the label: (bins, labels, 2)."""
    out = np.zeros((BINS, len(LABELS), 2))
    at = np.clip(np.floor(s / BIN) + BINS // 2, 0, BINS - 1).astype(np.int64)
    for k in range(len(LABELS)):
        out[:, k, 0], out[:, k, 1] = np.bincount(at[:, k], minlength=BINS), np.bincount(at[:, k], weights=y[:, k], minlength=BINS)
    return out


def best_f1(n: np.ndarray) -> np.ndarray:
    """Each label's threshold of the best F1, midway between the bin that is in and the next that isn't empty; 0 for a label that nothing has."""
    at = np.zeros(len(LABELS))
    for k in range(len(LABELS)):
        if n[:, k, 1].sum():
            has = np.nonzero(n[:, k, 0])[0][::-1]
            f1 = 2 * np.cumsum(n[has, k, 1]) / (np.cumsum(n[has, k, 0]) + n[:, k, 1].sum())
            i = int(f1.argmax())
            at[k] = ((has[i] + has[min(i + 1, len(has) - 1)] + 1) / 2 - BINS // 2) * BIN
    return at


def _conversations(df: DataFrame) -> DataFrame:
    t = F.col("conversations")
    return df.where(F.size(t) > 0).select("row_id", F.transform(t, lambda x: norm_role(x["from"])).alias("roles"), F.transform(t, lambda x: x["value"]).alias("values"))


def _pairs(roles: list[str], values: list[str | None]) -> Iterator[tuple[int, str | None, str | None]]:
    q = None
    for i, (r, v) in enumerate(zip(roles, values, strict=True)):
        if r == "human":
            q = v
        elif r == "gpt":
            yield i, q, v


def label(s: np.ndarray) -> str | None:
    """The first label whose score is over its threshold; an empty reply can't be judged for anything else, a copy or refusal isn't judged for its language."""
    return next((LABELS[k] for k in range(len(LABELS)) if s[k] > 0), None)


def _classify(model: Model):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 400):
                part = b.slice(lo, 400)
                rows, pos, pairs = [], [], []
                for i, r, v, e in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                    early = {x["turn_pos"]: x["evidence"] for x in e or ()}
                    for p, q, a in _pairs(r, v):
                        rows.append(i), pos.append(p), pairs.append((q, a, early.get(p)))
                if not rows:
                    continue
                defect = [label(x) for x in model.scores(pairs)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(pos, pa.int32()), pa.array(defect, pa.string())], names=["row_id", "turn_pos", "defect"])

    return run


def _mix(h: int) -> int:
    """:func:`mix` of one number."""
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & _M
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & _M
    return h ^ (h >> 31)


def _cut_at(row: int, pos: int, n: int) -> tuple[int, bool]:
    """Where the cut copy of a reply of n characters ends, and whether it counts as cut at a field limit: by a hash of its place."""
    h = _mix(((row or 0) + _mix(pos + 1)) & _M)
    return 15 + h % (n - 23), (h >> 40) % 6 == 0


def _sound(row: int, roles: list[str], values: list[str | None]) -> Iterator[tuple[int, str, str, str | None, bool]]:
    """Of a conversation's pairs with something in both: place, question, reply, and its cut copy (None for a short reply)."""
    for p, q, a in _pairs(roles, values):
        if q and not bare(a):
            at, limit = _cut_at(row, p, len(a)) if len(a) > 30 else (0, False)
            yield p, q, a, a[:at] if at else None, limit


def _cut_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 400):
            part = b.slice(lo, 400)
            got = [(i, p, c) for i, r, v in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True) for p, _, _, c, limit in _sound(i, r, v) if c and not limit]
            rows, pos, cut = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(pos, pa.int32()), pa.array([""] * len(rows), pa.string()), pa.array(["gpt"] * len(rows), pa.string()), pa.array(cut, pa.string())], names=["row_id", "turn_pos", "source_file", "role", "value"])


def _blocks(batches: Iterator[pa.RecordBatch], rows: int, folds: int = 2) -> Iterator[tuple[int, int, list[Pair], list[Pair]]]:
    """All rows (row_id, roles, values, early, short), in blocks of a fold: the fold, a seed, real pairs and cut ones."""
    held = [[0, 0, 0, [], []] for _ in range(folds)]  # rows, characters, seed
    for b in batches:
        for lo in range(0, b.num_rows, 400):
            part = b.slice(lo, 400)
            for i, r, v, e, c in zip(*(part.column(k).to_pylist() for k in range(5)), strict=True):
                fold = (_mix((i or 0) & _M) >> 32) % folds
                own = held[fold]
                early, why = {x["turn_pos"]: x["evidence"] for x in e or ()}, {x["turn_pos"]: x["evidence"] for x in c or ()}
                own[0], own[2] = own[0] + 1, own[2] or (i or 0) & 0x7FFFFFFF
                for p, q, a, short, limit in _sound(i, r, v):
                    own[1] += len(q) + len(a)
                    own[3].append((q, a, early.get(p)))
                    if short:
                        own[4].append((q, short, "limit" if limit else why.get(p)))
                if own[0] >= rows or own[1] >= BLOCK_CHARS:
                    yield fold, *own[2:]
                    held[fold] = [0, 0, 0, [], []]
    for fold, own in enumerate(held):
        if own[3]:
            yield fold, *own[2:]


def _texts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[list[str], list[str]]]:
    """The prose of the sound pairs of all rows (row_id, roles, values), in blocks: questions and replies."""
    own, chars, q, a = 0, 0, [], []
    for b in batches:
        for lo in range(0, b.num_rows, 400):
            part = b.slice(lo, 400)
            for r, v in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                for _, x, y in _pairs(r, v):
                    if x and not bare(y):
                        q.append(prose(x)), a.append(prose(answer(y)))
                        chars += len(x) + len(y)
                own += 1
                if own >= rows or chars >= BLOCK_CHARS:
                    yield q, a
                    own, chars, q, a = 0, 0, [], []
    if q:
        yield q, a


def _numbers(keys: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Rows (key, v) for :func:`_summed`; a row of zeros isn't sent."""
    some = v.any(1)
    flat = pa.ListArray.from_arrays(pa.array(np.arange(some.sum() + 1) * v.shape[1], pa.int32()), pa.array(v[some].ravel(), pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(keys[some], pa.int32()), flat], names=["key", "v"])


def _summed(rows: DataFrame, f, keys: int, width: int) -> np.ndarray:  # noqa: ANN001
    """The sums of what the tasks send, as many numbers at any size of the input."""
    sums = rows.mapInArrow(f, "key int, v array<double>").groupBy("key").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(width)]).alias("v"))
    out = np.zeros((keys, width))
    for b in sums.toArrow().to_batches():
        if b.num_rows:
            out[b.column("key").to_numpy()] = b.column("v").flatten().to_numpy().reshape(-1, width)
    return out


def _candidates(rows: int, k: int):  # noqa: ANN202
    """EM_TEXTS texts of a task that are unlike each other, and how many of its texts each stands for."""

    def pick(texts: list[str], times: np.ndarray, n: int, rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
        seeds, near = unlike(texts, times, n, rng)
        some = near.max(1, initial=0) > 0
        times = np.bincount(near[some].argmax(1), weights=times[some], minlength=len(seeds)) if seeds else times[:0]
        return [texts[i] for i, y in zip(seeds, times, strict=True) if y], times[times > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng, texts, times = np.random.default_rng(5), [], np.zeros(0)
        for questions, answers in _texts(batches, rows):
            new = questions + answers
            more, n = pick(new, np.ones(len(new)), k, rng)
            texts, times = texts + more, np.concatenate([times, n])
            if len(texts) > 2 * EM_TEXTS:
                texts, times = pick(texts, times, EM_TEXTS, rng)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(times, pa.float64())], names=["text", "times"])

    return run


def _round(languages: Languages, rows: int):  # noqa: ANN202
    """One round of expectation maximisation: trigrams by cluster, then texts by cluster, the likelihood, and pairs by their clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(languages.prior)
        out = np.zeros((2**GRAM_BITS + 2 + k, k))
        for questions, answers in _texts(batches, rows):
            sums, mass, fit, best = languages.step(questions + answers)
            out[: 2**GRAM_BITS] += sums
            out[2**GRAM_BITS] += mass
            out[2**GRAM_BITS + 1, 0] += fit
            out[2**GRAM_BITS + 2 :] += languages.met(best[: len(questions)], best[len(questions) :])
        yield _numbers(np.arange(len(out)), out)

    return run


def learn_languages(conv: DataFrame, rows: int = BLOCK_ROWS, k: int = CLUSTERS) -> Languages:
    """The languages of all texts of ``conv``."""
    conv = conv.select("row_id", "roles", "values")
    start = conv.mapInArrow(_candidates(rows, k), "text string, times double").collect()  # some a task
    texts, times = [r.text for r in start], np.array([r.times for r in start])
    languages = max((Languages([], texts, k, seed=i, times=times) for i in range(EM_STARTS)), key=lambda x: x.fit)
    last = -np.inf
    for _ in range(EM_ROUNDS):
        got = _summed(conv, _round(languages, rows), 2**GRAM_BITS + 2 + k, k)
        fit = got[2**GRAM_BITS + 1, 0]
        languages.link(got[2**GRAM_BITS + 2 :])  # of the clusters with which this round began
        if fit - last <= EM_GAIN * abs(fit):
            break
        last = fit
        languages.refit(got[: 2**GRAM_BITS], got[2**GRAM_BITS])
    else:
        languages.link(_summed(conv, _round(languages, rows), 2**GRAM_BITS + 2 + k, k)[2**GRAM_BITS + 2 :])
    return languages


def _descents(languages: Languages, rows: int, least: int, batch: int):  # noqa: ANN202
    """Weights times their sums of squared gradients, and these sums, of both folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, model = [Descent(), Descent()], Model(languages)
        for fold, seed, pairs, cut in _blocks(batches, rows):
            x = Examples(pairs, cut, languages, seed)
            if x.size:
                fits[fold].learn(x, model, np.ones(x.size, bool), max(4, -(-least // x.size)), batch)
        for fold, fit in enumerate(fits):
            if fit.times:
                m = np.concatenate([fit.mh.T, fit.md])
                w = np.concatenate([fit.sh.T, fit.sd]) / fit.times
                m[m <= 1e-6] = 0
                yield _numbers(np.arange(len(m)) + fold * len(m), np.concatenate([w * m, m], 1))

    return run


def _scored(models: list[Model], rows: int):  # noqa: ANN202
    """Counts of the scores that each fold's pairs have from the other fold's model; what is taken as sound but looks defective isn't counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((BINS, len(LABELS), 2))
        for fold, seed, pairs, cut in _blocks(batches, rows):
            x = Examples(pairs, cut, models[0].languages, seed)
            if x.size:
                s = models[1 - fold].raw(x.f)
                own = (x.y.sum(1) > 0) | (s <= 0).all(1)
                out += counted(s[own], x.y[own])
        yield _numbers(np.arange(BINS), out.reshape(BINS, -1))

    return run


def fit(conv: DataFrame, languages: Languages, n: int, rows: int = BLOCK_ROWS, steps: int = 300, batch: int = 384) -> Model:
    """The model of all n rows of ``conv`` (row_id, roles, values, early, short): the mean of both folds' models, with thresholds from the scores of all pairs."""
    least = steps * batch * min(rows, n) // max(n, 1)  # a block's share of the examples that make so many steps
    width = 2**BITS + len(DENSE)
    got = _summed(conv, _descents(languages, rows, least, batch), 2 * width, 2 * len(LABELS)).reshape(2, width, -1)

    def mean(part: np.ndarray) -> Model:
        model = Model(languages)
        w = part[:, : len(LABELS)] / np.where(part[:, len(LABELS) :] > 0, part[:, len(LABELS) :], 1)
        model.hashed, model.dense = w[: 2**BITS].astype(np.float32), w[2**BITS :].astype(np.float32)
        return model

    folds = [mean(p) if p.any() else mean(got.sum(0)) for p in got]
    model = mean(got.sum(0))
    model.at = best_f1(_summed(conv, _scored(folds, rows), BINS, 2 * len(LABELS)).reshape(BINS, len(LABELS), 2))
    return model


def defects(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(row_id, turn_pos, defect)`` of every defective gpt turn; at most one defect each, in the order empty, copy,
    refusal, truncated, language.

    The model is fitted on all rows, ``block_rows`` at a time in each task; every reply is classified. A reply
    without a human turn before it has an empty question. Null values are empty. Rows delivered again each come out. Empty
    tables give no rows.
    """
    found = written(truncation.forms(truncation.turns(df)), "forms")
    stats = truncation.learn(truncation.turns(df), found)
    open_ = written(truncation.weighed(found, stats), "weighed")
    limits = truncation.field_limits(open_)

    def by_row(x: DataFrame, name: str) -> DataFrame:
        return x.groupBy("row_id").agg(F.collect_list(F.struct("turn_pos", "evidence")).alias(name))  # one row's turns

    conv = _conversations(df)
    # the evidence that the corpus's statistics give for cut copies of all replies
    cut = written(truncation.forms(conv.mapInArrow(_cut_values, "row_id long, turn_pos int, source_file string, role string, value string")), "cutforms")
    why = truncation.judge(truncation.weighed(cut, stats), limits)
    all_ = conv.join(by_row(truncation.judge(open_, limits), "early"), "row_id", "left").join(by_row(why, "short"), "row_id", "left")
    all_ = written(all_.select("row_id", "roles", "values", "early", "short"), "replies")
    discard(found, open_, cut)
    n = all_.count()
    parts = all_.coalesce(max(1, n // (2 * block_rows)))  # tasks of a block of each fold at least
    model = fit(parts, learn_languages(parts, block_rows), n, block_rows)
    return all_.mapInArrow(_classify(model), "row_id long, turn_pos int, defect string").where("defect is not null")
