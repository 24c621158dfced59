WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """n words, no repetition to speak of."""
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 16) % len(WORDS)] + WORDS[(state >> 8) % len(WORDS)])
    return " ".join(out)
