"""The propagation written out over the full matrix of nodes and users, in plain Python."""


def dense_labels(edges, users, max_iter=15, tol=0.05):
    """``edges``: (src, dst, w) over typed node pairs. Returns non-zero labels and rounds run."""
    nodes = {("user", u) for u in users}
    nodes |= {s for s, _, _ in edges} | {d for _, d, _ in edges if d[0] != "user"}
    labels = {n: {u: 1.0 if n == ("user", u) else 0.0 for u in users} for n in nodes}
    rounds = 0
    for _ in range(max_iter):
        rounds += 1
        new = {}
        for src, dst, w in edges:
            if src in labels and dst in labels:
                row = new.setdefault(dst, dict.fromkeys(users, 0.0))
                for u, value in labels[src].items():
                    row[u] += w * value
        for node, row in new.items():
            if node[0] == "user" and row[node[1]] < 1:
                row[node[1]] = 1.0
            total = sum(row.values())
            for u in row:
                row[u] = row[u] / total if total else 0.0
        moved = any(abs(labels[n][u] - new[n][u]) > tol for n in new for u in new[n])
        labels = new
        if not moved:
            break
    flat = {(n[0], n[1], u): w for n, row in labels.items() for u, w in row.items() if w > 0}
    return flat, rounds
