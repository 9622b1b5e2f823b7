"""One cleaning plan per survey."""

from tidemerge.plans.surveys import (
    baystudy, djfmp, dop, edsm, emp, fmwt, ncro, sdo, skt, sls, stn, suisun, twentymm, usbr, usgs_cawsc, usgs_sfbs,
    ybfmp,
)
from tidemerge.sources.registry import Survey

_MODULES = {
    "20mm": twentymm, "Baystudy": baystudy, "DJFMP": djfmp, "DOP": dop, "EDSM": edsm, "EMP": emp, "FMWT": fmwt,
    "NCRO": ncro, "SDO": sdo, "SKT": skt, "SLS": sls, "STN": stn, "Suisun": suisun, "USBR": usbr,
    "USGS_CAWSC": usgs_cawsc, "USGS_SFBS": usgs_sfbs, "YBFMP": ybfmp,
}

SURVEYS = {
    name: Survey(name, module.FEEDS, module.clean, getattr(module, "HEADERS", {}), getattr(module, "SHAPES", {}))
    for name, module in _MODULES.items()
}
