import ctypes
import os

import pytest

from lexigraft.llm.noise import bigrams
from lexigraft.llm.scans import _settle
from lexigraft.session import release

PIECES, SIZE = 1000, 1 << 16


def resident(pid):
    with open(f"/proc/{pid}/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


@pytest.fixture
def unsafe(spark):
    """Native memory of the JVM."""
    field = spark.sparkContext._jvm.java.lang.Class.forName("sun.misc.Unsafe").getDeclaredField("theUnsafe")
    field.setAccessible(True)
    return field.get(None)


def test_release_hands_back_native_memory(spark, unsafe):
    libc = ctypes.CDLL(None)
    libc.malloc.restype, libc.malloc.argtypes, libc.free.argtypes = ctypes.c_void_p, [ctypes.c_size_t], [ctypes.c_void_p]
    pieces = [libc.malloc(SIZE) for _ in range(PIECES)]
    for p in pieces:
        ctypes.memset(p, 1, SIZE)
    jvm_pieces = [unsafe.allocateMemory(SIZE) for _ in range(PIECES)]
    for p in jvm_pieces:
        unsafe.setMemory(p, SIZE, 1)
    pids = os.getpid(), spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()
    for p, q in zip(pieces[:-1], jvm_pieces[:-1]):  # the last ones keep the C library from giving back the rest by itself
        libc.free(p)
        unsafe.freeMemory(q)
    before = [resident(p) for p in pids]
    release(spark)
    after = [resident(p) for p in pids]
    libc.free(pieces[-1])
    unsafe.freeMemory(jvm_pieces[-1])
    assert all(b - a > PIECES * SIZE // 2 for b, a in zip(before, after)), (before, after)


def test_settled_driver_remembers_no_bigrams(spark):
    bigrams("remembered")
    _settle(spark)
    assert bigrams.cache_info().currsize == 0
