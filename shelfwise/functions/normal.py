"""Normal distribution as Column expressions; Spark SQL has neither erf nor a quantile."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Coefficients of Wichura's AS241 (PPND16), lowest power first.
PPF_CENTRAL = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
PPF_MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
PPF_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)

# Hart's (1968) double precision rational form of the upper tail, lowest power first.
CDF_TOP = (220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383,
           6.37396220353165, 0.700383064443688, 3.52624965998911e-2)
CDF_BOTTOM = (440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674,
              86.7807322029461, 16.064177579207, 1.75566716318264, 8.83883476483184e-2)
CDF_SWITCH = 7.07106781186547
CDF_FAR = 37.0
SQRT_TWO_PI = 2.506628274631


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def _rational(pair: tuple[tuple[float, ...], tuple[float, ...]], x: Column) -> Column:
    return _poly(pair[0], x) / _poly(pair[1], x)


def norm_ppf(p: Column, mean: Column | float = 0.0, sd: Column | float = 1.0) -> Column:
    """Quantile of a normal distribution; NULL outside (0, 1)."""
    q = p - 0.5
    tail = F.when(q < 0, p).otherwise(1.0 - p)
    r = F.sqrt(-F.log(tail))
    upper = F.when(r <= 5.0, _rational(PPF_MIDDLE, r - 1.6)).otherwise(_rational(PPF_TAIL, r - 5.0))
    z = (
        F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
        .when(F.abs(q) <= 0.425, q * _rational(PPF_CENTRAL, 0.180625 - q * q))
        .when(q < 0, -upper)
        .otherwise(upper)
    )
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    sd = sd if isinstance(sd, Column) else F.lit(sd)
    return mean + sd * z


def norm_cdf(x: Column, mean: Column | float = 0.0, sd: Column | float = 1.0) -> Column:
    """Distribution function of a normal; ``sd`` must be positive."""
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    sd = sd if isinstance(sd, Column) else F.lit(sd)
    z = (x - mean) / sd
    a = F.abs(z)
    density = F.exp(-a * a / 2.0)
    near = density * _poly(CDF_TOP, a) / _poly(CDF_BOTTOM, a)
    far = density / (a + 1.0 / (a + 2.0 / (a + 3.0 / (a + 4.0 / (a + 0.65))))) / SQRT_TWO_PI
    upper = F.when(a > CDF_FAR, F.lit(0.0)).when(a < CDF_SWITCH, near).otherwise(far)
    return F.when(z > 0, 1.0 - upper).otherwise(upper)
