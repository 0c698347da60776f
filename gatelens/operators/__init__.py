"""The twelve user operations and the pieces they are composed of."""
