"""The scoring rules written as one plain loop, to check the distributed scorers against."""


def serial_scores(rows, threshold=3.0, sustained=5, warmup=10):
    """rows: (meter, order, kwh) -> {(meter, order): (n, mean, sd, z, label, severity, counter)}"""
    states, out = {}, {}
    for meter, order, x in sorted(rows):
        n, mean, m2, c = states.get(meter, (0, 0.0, 0.0, 0))
        n += 1
        d = x - mean
        mean += d / n
        m2 += d * (x - mean)
        sd = (m2 / n) ** 0.5 if n > 1 else 0.0
        z = (x - mean) / sd if sd > 0.001 and n >= warmup else 0.0
        label, severity = "normal", 0.0
        if n >= warmup:
            if x < 0.005:
                label, severity = "flatline", 1.0
            elif z > threshold:
                label, severity, c = "sudden_spike", min(abs(z) / threshold, 5.0), c + 1
            elif c >= sustained and z > 2.0:
                label, severity = "sustained_elevation", 2.0 + c / 10
            elif z > 2.0:
                c += 1
            else:
                c = max(0, c - 1)
        states[meter] = (n, mean, m2, c)
        out[meter, order] = (n, mean, sd, z, label, severity, c)
    return out
