"""DataFrame operators: every function maps frames and run parameters to a frame."""
