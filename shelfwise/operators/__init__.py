"""DataFrame operators: each takes frames and returns frames, lazily unless its text says otherwise."""
