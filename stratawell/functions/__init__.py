"""Column helpers and storage locations shared by the operators."""
