"""Column helpers and distributed window patterns shared by the operators."""
