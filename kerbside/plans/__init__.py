"""The jobs: which operator reads and writes which layer."""
