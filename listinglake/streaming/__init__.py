"""The stateless normalisers over a landing folder that keeps growing."""
