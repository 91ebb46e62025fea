"""Row-major grids held as arrays: intensity, block means, gradients, features.

A grid column is ``array<number>`` of ``height * width`` cells.  All functions are
narrow: no explode, no window, no shuffle.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.lambdas import bind


def _cells(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1)) if n > 0 else F.array().cast("array<int>")


def _div(i: Column, n: int) -> Column:
    return F.floor(i / F.lit(n)).cast("int")


def _check_block(height: int, width: int, block: int) -> None:
    if height % block or width % block:
        raise ValueError(f"a {height}x{width} grid cannot be cut into {block}x{block} blocks")


def pixel_intensity(red: Column, green: Column, blue: Column, infrared: Column) -> Column:
    """``trunc(mean(red, green, blue) * infrared / 100)`` for one pixel."""
    return ((red + green + blue) / F.lit(3.0) * infrared / F.lit(100.0)).cast("int")


def intensity(pixels: Column, n_pixels: int, channels: int = 4) -> Column:
    """Intensity per pixel of a channel-last pixel array (red, green, blue, infrared, ..)."""
    return bind(
        pixels,
        lambda p: F.transform(
            _cells(n_pixels),
            lambda i: pixel_intensity(*(F.get(p, i * channels + c) for c in range(4))),
        ),
    )


def sub_grid(grid: Column, width: int, top: int, left: int, height: int, out_width: int) -> Column:
    """The ``height x out_width`` window of a grid whose upper left cell is (top, left)."""
    strips = [F.slice(grid, (top + r) * width + left + 1, out_width) for r in range(height)]
    return F.concat(*strips)


def block_mean(grid: Column, height: int, width: int, block: int) -> Column:
    """Mean of each ``block x block`` square: exact integer sum, then one division."""
    _check_block(height, width, block)
    out_w = width // block
    n_out = (height // block) * out_w
    inner = _cells(block * block)

    def one(g: Column, i: Column) -> Column:
        corner = _div(i, out_w) * (block * width) + i % out_w * block
        total = F.aggregate(
            inner,
            F.lit(0).cast("double"),
            lambda acc, j: acc + F.get(g, corner + _div(j, block) * width + j % block),
        )
        return total / F.lit(float(block * block))

    return bind(grid, lambda g: F.transform(_cells(n_out), lambda i: one(g, i)))


def _less_shifted(grid: Column, cells: int, by: int) -> Column:
    """Each cell's ``by``-th successor minus the cell, for the cells that have one."""
    n = cells - by
    return bind(grid, lambda g: F.zip_with(F.slice(g, by + 1, n), F.slice(g, 1, n), lambda b, a: b - a))


def row_diff(grid: Column, height: int, width: int) -> Column:
    """Right neighbour minus cell, row by row: ``height x (width-1)``."""
    steps = _less_shifted(grid, height * width, 1)
    return F.filter(steps, lambda _, i: i % width != width - 1)  # not from one row to the next


def col_diff(grid: Column, height: int, width: int) -> Column:
    """Lower neighbour minus cell: ``(height-1) x width``."""
    return _less_shifted(grid, height * width, width)


def discretize(x: Column, threshold: float = 1) -> Column:
    """1 above the threshold, -1 below its negative, 0 between (both ends included)."""
    return (
        F.when(x > threshold, F.lit(1)).when(x < -threshold, F.lit(-1)).otherwise(F.lit(0)).cast("tinyint")
    )


def row_diff_sign(grid: Column, height: int, width: int, threshold: float = 1) -> Column:
    return F.transform(row_diff(grid, height, width), lambda x: discretize(x, threshold))


def col_diff_sign(grid: Column, height: int, width: int, threshold: float = 1) -> Column:
    return F.transform(col_diff(grid, height, width), lambda x: discretize(x, threshold))


def feature_vector(grid: Column, height: int, width: int, threshold: float = 1) -> Column:
    """Signs of the row differences, row-major, followed by those of the column differences."""
    return bind(
        grid,
        lambda g: F.concat(
            row_diff_sign(g, height, width, threshold), col_diff_sign(g, height, width, threshold)
        ),
    )
