"""The hashes of wordlens.llm.arrays by plain integers, for brute forces that share no code with the operators."""

M = (1 << 64) - 1
BYTES, WORDS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mix(x):
    x &= M
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M
    return x ^ x >> 31


def polynomial(values, base):
    total, power = 0, 1
    for v in values:
        total, power = total + v * power & M, power * base & M
    return total


def of_bytes(b):
    return mix(polynomial([c + 1 for c in b], BYTES) + len(b))


def of_sequence(values):
    return mix(polynomial(values, WORDS) + len(values))
